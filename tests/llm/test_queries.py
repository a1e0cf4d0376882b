"""The registered queries of this package: those with SQL against it, all for their columns."""

import duckdb
import pytest

import corpus_pipeline
from pageloom.llm import queries
from tests.test_registry import TABLES, plain

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_simhash": ["doc_id", "fingerprint", "component_id"],
    "op2_substring_dedup": ["doc_id", "n_words", "n_removed", "kept_sha256"],
    "op3_suffix_array_dedup": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op5_embedding_dedup": ["vec_id", "n_links", "component_id", "kept"],
    "op6_sentencepiece": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op8_language_id": ["doc_id", "held_out", "lang_pred", "score"],
    "op9_url_filter": ["page_id", "host", "path", "rule", "verdict"],
    "op11_lm_scoring": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    "op12_periodic_runs": [
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256",
    ],
    "op13_filter_audit": [
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley",
    ],
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_contract(spark, name):
    assert set(COLUMNS[name]) <= set(queries.QUERIES[name](spark, SF).columns)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_sql(spark, name, sf):
    sf = f"/root/testdata/{sf}"
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    got, expected = queries.QUERIES[name](spark, sf).toPandas(), con.execute(queries.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(expected.columns)
    assert plain(got) == plain(expected)


def test_pipeline(spark):
    """Each stage against a plain form of what it promises."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    extra = [(900_001, None, "en", "x", 0), (900_002, "12 34", None, None, 2), (None, "words here", "en", "x", 1)]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema)).unionByName(docs.limit(3))
    seen = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        seen.append(stage(spark, seen[-1], SF).cache())
        if k < len(corpus_pipeline.STAGES) - 1:
            assert seen[-1].columns == columns
    ids = [[r.doc_id for r in x.select("doc_id").collect()] for x in seen]
    assert not {900_001, 900_002, None} & set(ids[1])
    readable = [r.doc_id for r in docs.collect() if r.doc_id is not None and any(c.isalpha() for c in r.text or "")]
    assert sorted(ids[1]) == sorted(readable)
    from tests.llm.test_shingle_dedup import brute as near

    assert sorted(ids[2]) == sorted({c for _, c in near([(r.doc_id, r.text) for r in seen[1].collect()])})
    from tests.llm.test_repeats import brute_bytes

    rows = [(r.doc_id, r.text) for r in seen[2].collect()]
    kept = {k: v[3].decode(errors="ignore") for k, v in brute_bytes(rows).items()}
    assert {r.doc_id: r.text for r in seen[3].collect()} == {k: t for k, t in kept.items() if any(c.isalpha() for c in t)}
    assert all(r.n_chars == len(r.text) for r in seen[3].collect())
    from tests.llm.test_decontamination import brute

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaked = {k for k, _ in brute([(r.doc_id, r.text) for r in seen[3].collect()], items)}
    assert sorted(ids[4]) == sorted(set(ids[3]) - leaked)
    assert sorted(ids[5]) == sorted(ids[4])


def test_pipeline_repeated_ids(spark):
    """Rows of one id but different texts are judged each; rows that repeat count once."""
    x, y = " ".join(f"x{i}" for i in range(40)), " ".join(f"y{i}" for i in range(40))
    u, v = " ".join(f"u{i}" for i in range(40)), " ".join(f"v{i}" for i in range(40))
    rows = [(3, x), (5, x), (5, y), (7, u), (7, v), (7, v), (8, v + " more"), (9, "12"), (9, "nine"), (5, None)]
    docs = spark.createDataFrame([(k, t, "en", "s", len(t or ""), 1) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long, row int")
    first = corpus_pipeline.readable(spark, docs, SF)
    assert sorted((r.doc_id, r.text) for r in first.collect()) == sorted(r for r in rows if r[1] not in (None, "12"))
    second = corpus_pipeline.without_near_duplicates(spark, first, SF)
    assert second.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in second.collect()) == sorted([(3, x), (5, y), (7, u), (7, v), (9, "nine")])
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    leaky = second.unionByName(spark.createDataFrame([(7, item, "en", "s", 1, 1)], docs.schema))
    kept = corpus_pipeline.without_benchmark(spark, leaky, SF)
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted((r.doc_id, r.text) for r in second.collect())
