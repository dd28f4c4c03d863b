import zlib

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

#: Columns whose names operators might use inside.
CLASHING = "token string, n long, c1 long, part string, start long, length long, root long, spans string, score string, _id string"


@pytest.fixture
def documents(spark):
    """Builds a documents table from (doc_id, text) pairs, spread over a few partitions."""
    def build(rows, partitions=3):
        data = [(i, t, "en", "src", None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(data, SCHEMA).repartition(partitions)
    return build


@pytest.fixture
def clashing(spark, documents):
    """The same with extra columns of clashing names, all null."""
    def build(rows, partitions=3):
        df = documents(rows, partitions)
        for c in CLASHING.split(", "):
            name, kind = c.split(" ")
            df = df.selectExpr("*", f"cast(null as {kind}) as {name}")
        return df
    return build


@pytest.fixture
def written(documents, tmp_path):
    """Writes documents (and other tables) as a folder that queries read."""
    def build(rows, **tables):
        documents(rows).write.parquet(f"{tmp_path}/documents.parquet")
        for name, df in tables.items():
            df.write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)
    return build


def fold(doc_id, parts):
    return zlib.crc32(str(doc_id).encode()) % parts


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


EDGE_TEXTS = [None, "", " ", "\n\n", "a", "A a A a", "é" * 50, "x" * 100_000, "word " * 20_000, "　\x1c\x85 mixed\tblanks\x0b"]
