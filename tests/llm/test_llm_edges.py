"""Every corpus operator and pipeline stage on awkward tables: nulls, empty and long texts,
ties, repeated rows, further columns with clashing names, no rows at all."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from webevents.llm.queries import QUERIES

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ("id", "doc", "size", "n_lines", "n_dropped", "rules", "rules_kept", "copies", "component", "fp", "target", "taken",
            "ids", "core", "place", "rank", "part", "a", "b", "_id", "_text", "epoch", "position", "_kept", "record_type", "h1")
LONG = " ".join(f"word{i % 977}x{i % 13}" for i in range(60_000))
PROSE = "The quick brown fox met a lazy dog near the old mill, and both of them went home before it was dark. " * 2 + "\n"


def document_rows():
    clean = [" ".join(f"{a}{b}" for b in range(i, i + 70)) for i, a in enumerate("abcdefghij")]
    rows = [(i, t, "en", "src1", len(t)) for i, t in enumerate(clean)]
    rows += [
        (20, None, "en", "src1", None), (21, "", None, None, 0), (22, "\n\n \t", "en", None, 4), (23, LONG, "en", "src2", len(LONG)),
        (24, clean[0], "en", "src1", 5), (25, clean[0] + " z", None, "src2", 6), (26, PROSE + clean[3], "en", "src3", 7),
        (27, PROSE + clean[4], "en", "é", 8), (28, PROSE + clean[5], "en", "", 9), (None, clean[6], "en", "src1", 10),
        (None, None, None, None, None), (1, clean[1], "en", "src1", len(clean[1])), (1, clean[1], "en", "src1", len(clean[1])),
        (29, "<|endoftext|> \U0001f600 \x00 \x1c", "en", "src4", 3), (-5, clean[7], "en", "src1", 1),
        (30, "alpha beta gamma. " * 40, None, "src4", 1), (31, 'token = "abcdef0123456789abcdef0123"', "en", "src4", 1),
    ]
    return rows


TABLES = {
    "documents": (DOCS, document_rows()),
    "labels": ("doc_id long, quality int, toxic int",
               [(i, int(i % 4 > 0), 0) for i in range(10)] + [(1, 0, None), (None, 1, 0), (3, None, 1), (99, 0, 0)]),
    "benchmark": ("item_id long, text string",
                  [(1, "the quick brown fox"), (2, None), (3, ""), (4, "nowhere to be found"), (None, "word1x1 ALPHA"), (1, "the quick brown fox")]),
    "embeddings": ("vec_id long, embedding array<float>, label int",
                   [(i, [float(i % 7), 1.0, float(i % 3)], 1) for i in range(60)]
                   + [(60, None, 1), (80, [], None), (100, [0.0] * 3, 1), (120, [None, 1.0, 1.0], 1), (None, [1.0] * 3, 1), (0, [0.0, 1.0, 0.0], 1)]),
    "pages": ("page_id long, url string, html string",
              [(i, f"http://a/{i}", "<p>" + "same " * 40) for i in range(5)]
              + [(10, None, None), (11, "", ""), (12, "http://a b/\r\né", "short"), (13, "u", "short"), (None, "u", "<p>" + "same " * 40),
                 (0, "http://a/0", "<p>" + "same " * 40), (14, "u", "é" * 300_000), (None, None, None)]),
}


def write(spark, folder, empty=False, clashing=False):
    for name, (schema, rows) in TABLES.items():
        df = spark.createDataFrame([] if empty else rows, schema)
        if clashing:
            df = df.select("*", *[F.lit(c).alias(c) for c in CLASHING if c not in df.columns])
        df.repartition(3).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    return write(spark, tmp_path_factory.mktemp("odd"))


@pytest.fixture(scope="module")
def clashing(spark, tmp_path_factory):
    return write(spark, tmp_path_factory.mktemp("clashing"), clashing=True)


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    return write(spark, tmp_path_factory.mktemp("empty"), empty=True)


_results = {}


def result(spark, name, folder):
    """Columns and rows of a query, run once per table folder."""
    if (name, folder) not in _results:
        df = QUERIES[name](spark, folder)
        _results[name, folder] = df.columns, df.collect()
    return _results[name, folder]


def table_of(name):
    return {"op9_multiprobe": "embeddings", "op10_warc_zstd": "pages"}.get(name, "documents")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_odd_rows_have_results(spark, odd, name):
    _, rows = result(spark, name, odd)
    if name == "op9_multiprobe":
        assert {r["query_id"] for r in rows} == {0, 20, 40} and len(rows) == 60
    elif name == "op12_treap_search":
        assert {r["item_id"] for r in rows} == {1, None} and max(r["rank"] for r in rows) == 3
        assert [r["doc_id"] for r in rows if r["item_id"] is None] == [30, 23]
    elif name == "op13_toivonen_phrases":
        assert [tuple(r) for r in rows] == [("und", 1, "alpha beta gamma", 40, 40, 40, 191, 1_000_000)]
    else:
        assert len(rows) == len(TABLES[table_of(name)][1])


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_further_columns_change_nothing(spark, odd, clashing, name):
    (columns, plain), (more_columns, more) = result(spark, name, odd), result(spark, name, clashing)
    assert columns == more_columns
    assert sorted(map(repr, plain)) == sorted(map(repr, more))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_rows_give_no_rows(spark, empty, name):
    df = QUERIES[name](spark, empty)
    assert df.columns and df.collect() == []


@pytest.mark.parametrize("where", ["odd", "clashing", "empty"])
@pytest.mark.parametrize("stage", range(len(corpus_pipeline.STAGES)))
def test_stages_take_odd_tables(spark, request, stage, where):
    sf_dir = request.getfixturevalue(where)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = corpus_pipeline.STAGES[stage][1](spark, docs, sf_dir)
    if stage < len(corpus_pipeline.STAGES) - 1:
        assert out.columns == docs.columns
    rows = out.collect()
    assert bool(rows) == (where != "empty")


def test_a_stage_keeps_further_columns_with_their_rows(spark, clashing):
    docs = spark.read.parquet(f"{clashing}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert all(r[c] == c for r in stage(spark, docs, clashing).collect() for c in CLASHING)
