"""The registered queries against their SQL, and the pipeline stage by stage."""

from __future__ import annotations

import sys
from pathlib import Path

import duckdb
import pytest
from check_queries import TABLES, compare

sys.path.insert(0, str(Path(__file__).resolve().parent))
from documents import SHAPE, frame, odd_documents  # noqa: E402

import __spark_entry__ as contract  # noqa: E402
import corpus_pipeline  # noqa: E402
from ledgerflow.llm import ORACLES, QUERIES  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return connection


def test_one_query_for_each_operator():
    numbers = {int(name[2:].split("_")[0]) for name in QUERIES}
    assert len(numbers) == len(QUERIES) and numbers == set(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, duck, name):
    assert compare(QUERIES[name](spark, SMALL), duck.sql(ORACLES[name])) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_returns_its_rows(spark, name):
    assert QUERIES[name](spark, SMALL).count() >= 200


def test_stages_keep_the_columns_and_take_any_documents(spark, tmp_path):
    """Every stage on awkward documents, and on none."""
    names = [f.name for f in SHAPE]
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for rows in (odd_documents(), []):
        docs = frame(spark, rows, extra=False)
        for _, function in corpus_pipeline.STAGES[:-1]:
            kept = function(spark, docs, str(tmp_path))
            assert kept.columns == names and kept.dtypes == docs.dtypes
            assert kept.count() <= 3 * len(rows)
        assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() >= len(rows)


def test_pipeline_agrees_with_brute_force(spark, duck):
    """The classifier's verdicts taken as given; all else by plain loops, SQL and the library."""
    from test_texts import brute_repeats, brute_similar, split
    from tokenizers import Tokenizer

    from ledgerflow.llm import mixing, toxicity
    from ledgerflow.llm.queries import vocabulary

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    clean = [tuple(r) for r in toxicity.without_toxic(docs, labels).collect()]
    assert 100 < len(clean) < docs.count() and len({r[0] for r in clean}) == len(clean)
    leaders = {key for key, least, _ in brute_similar(clean) if key == least}
    single = [r for r in clean if r[0] in leaders]
    assert len(single) < len(clean)
    first: dict[tuple, int] = {}
    for key, text, *_ in sorted(single):
        words = split(text)
        for i in range(len(words) - 12):
            first.setdefault(tuple(words[i : i + 13]), key)
    cut = []
    for key, text, lang, source, _ in single:
        words, gone = split(text), set()
        for i in range(len(words) - 12):
            if first[tuple(words[i : i + 13])] < key:
                gone |= set(range(i, i + 13))
        if gone:
            text = b" ".join(w for i, w in enumerate(words) if i not in gone).decode()
        cut.append((key, text, lang, source))
    assert sum(n for _, _, n, _ in brute_repeats(single)) > 0
    own = duckdb.connect()
    own.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
    own.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", cut)
    copies = dict(own.sql(f"SELECT doc_id, copies FROM ({mixing.ORACLE}) WHERE size > 0").fetchall())
    library = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    expected = {}
    for key, text, *_ in cut:
        if copies.get(key):
            tokens = len(library.encode(text, add_special_tokens=False).ids) + 1
            expected[key, tokens] = tokens * copies[key]
    # Groups depend on the split of the input, tokens do not.
    found = corpus_pipeline.run(spark, SMALL).groupBy("doc_id", "doc_tokens").sum("length").collect()
    assert {(r[0], r[1]): r[2] for r in found} == expected
