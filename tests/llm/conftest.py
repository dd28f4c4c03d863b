import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from text_fixtures import clashing, documents, written  # noqa: E402, F401
