"""Every operator and pipeline stage on the same odd tables: columns with the names of helper
columns, nulls in any column, repeated rows, ties, empty texts and empty tables."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lattica.llm import chat, classifier, decontam, licenses, linededup, minhash, packing, quality, secrets, tokencount

CLASHES = ["__drop", "__of", "__q", "__keep", "__lang", "__source", "__id", "__line", "__host", "__bytes", "__print", "__block", "___id", "id", "row", "piece", "block", "length", "all", "key", "label", "component", "n", "symbols_per_word_high", "__n", "spans", "license", "score"]
TEXT = "Some words in a row that are long enough to pass the rules of this place, with one more line.\nAll rights reserved.\ntoken = abcdef12"
ROWS = [(1, TEXT, "en", "a"), (1, TEXT, "en", "a"), (2, None, None, None), (3, "", "en", None), (None, TEXT, None, "a"), (4, TEXT + " and an end", "de", "a"), (5, " \n\t", "en", "a"), (None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    made = spark.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in ROWS], "doc_id long, text string, lang string, source string, n_chars long")
    return made.select("*", *[F.lit(k).alias(c) for k, c in enumerate(CLASHES)]).persist()


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, TEXT.split(",")[0]), (None, None), (2, ""), (1, "token")], "item_id long, text string")


#: Operators that keep their table, and those with a row for each or for what they find.
KEEPS = {
    "drop_lines": lambda d, b: linededup.drop_lines(d),
    "keep_good": lambda d, b: quality.keep_good(d),
    "keep_first": lambda d, b: minhash.keep_first(d),
    "drop_leaks": lambda d, b: decontam.drop_leaks(d, b),
}
ROWWISE = {
    "secret_spans": lambda d, b: secrets.secret_spans(d),
    "token_counts": lambda d, b: tokencount.token_counts(d),
    "scored": lambda d, b: classifier.scored(d, classifier.fit([], {})),
    "judged": lambda d, b: quality.judged(d, carry=["doc_id"]),
    "pack": lambda d, b: packing.pack(d),
}
FINDS = {
    "leaks": lambda d, b: decontam.leaks(d, b),
    "license_notices": lambda d, b: licenses.license_notices(d),
    "near_duplicates": lambda d, b: minhash.near_duplicates(d),
    "training_rows": lambda d, b: d.sparkSession.createDataFrame([(len(classifier.training_rows(d, d.withColumn("quality", F.lit(1)))[0]),)], "n int"),
    "sequences": lambda d, b: packing.sequences(d.filter("doc_id > 1"), packing.pack(d.filter("doc_id > 1"))),
}


@pytest.mark.parametrize("name", KEEPS)
def test_tables_with_clashing_columns_stay_whole(docs, bench, name):
    out = KEEPS[name](docs, bench)
    assert out.columns == docs.columns
    rows = out.collect()
    assert len(rows) <= len(ROWS) and all(r[c] == k for r in rows for k, c in enumerate(CLASHES))
    assert KEEPS[name](docs.limit(0), bench).collect() == []
    if name != "keep_good":  # which drops short and null texts by its base rules
        assert any(r["text"] is None for r in rows) and any(r["doc_id"] is None for r in rows)


@pytest.mark.parametrize("name", ROWWISE)
def test_every_row_has_a_result(docs, bench, name):
    assert ROWWISE[name](docs, bench).count() == len(ROWS)
    assert ROWWISE[name](docs.limit(0), bench).collect() == []


@pytest.mark.parametrize("name", FINDS)
def test_odd_rows_do_not_crash(docs, bench, name):
    assert FINDS[name](docs, bench).count() > 0
    FINDS[name](docs.limit(0), bench).collect()


@pytest.mark.parametrize("stage", [s for s, _ in corpus_pipeline.STAGES])
def test_stages(spark, docs, bench, stage, tmp_path):
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    run = dict(corpus_pipeline.STAGES)[stage]
    out = run(spark, docs, str(tmp_path))
    assert stage == "best_fit_packing" or out.columns == docs.columns
    out.collect()
    assert run(spark, docs.limit(0), str(tmp_path)).collect() == []


def test_conversations_with_clashing_columns(spark):
    rows = spark.createDataFrame([(1, 0, "user", "a"), (None, None, None, None), (1, 0, "user", "a")], "conv_id long, turn long, role string, text string")
    rows = rows.select("*", *[F.lit(k).alias(c) for k, c in enumerate([*CLASHES, "part", "ids", "mask", "seq", "__conv", "__part", "__tokens"])])
    got = {r["conv_id"]: r["n_turns"] for r in chat.read_back(chat.format_conversations(rows)).collect()}
    assert got == {1: 2, None: 1}
