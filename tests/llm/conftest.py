import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from texts, (id, text) pairs or (id, text, lang) triples."""

    def make(rows, partitions=2):
        full = []
        for i, r in enumerate(rows):
            r = r if isinstance(r, tuple) else (i, r)
            full.append((r[0], r[1], r[2] if len(r) > 2 else "en", "src0", len(r[1] or "")))
        return spark.createDataFrame(full, SCHEMA).repartition(partitions)

    return make


@pytest.fixture(scope="session")
def stored(spark, tmp_path_factory):
    """A frame as a table read (repeatable), under a fresh folder."""

    def store(df, name="t"):
        path = str(tmp_path_factory.mktemp("tables") / name)
        df.write.parquet(path)
        return spark.read.parquet(path)

    return store


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def duck_docs(sf_dir):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con
