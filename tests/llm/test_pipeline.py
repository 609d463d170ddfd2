"""The pipeline against a brute-force version of its stages."""

import collections
import hashlib

from pyspark.sql import functions as F

import corpus_pipeline
from parcelwright.llm import bpe
from parcelwright.plans.staging import stage
from tests.llm.test_brute_force import WORD, brute_kept, brute_lines, brute_mix
from tests.llm.test_operators import brute_links


def test_stages_step_by_step(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    all_rows = {r["doc_id"]: r for r in docs.collect()}
    (_, rules), (_, lines), (_, near), (_, mix), (_, encode) = corpus_pipeline.STAGES

    good = stage(rules(spark, docs, data), "t")
    kept, _ = brute_kept([(r["doc_id"], r["text"], r["lang"], r["source"]) for r in all_rows.values()])
    assert {r["doc_id"] for r in good.collect()} == {i for i, k in zip(all_rows, kept, strict=True) if k} and good.columns == list(corpus_pipeline.COLUMNS)
    assert all(tuple(r) == tuple(all_rows[r["doc_id"]]) for r in good.collect())

    clean = stage(lines(spark, good, data), "t")
    before = {r["doc_id"]: r["text"] for r in good.collect()}
    want = {i: t for i, t in brute_lines(list(before.items())).items() if t == before[i] or t.strip()}
    assert {r["doc_id"]: r["text"] for r in clean.collect()} == want and all(r["n_chars"] == len(r["text"]) for r in clean.collect())
    assert sum(t == all_rows[i]["text"] for i, t in want.items()) > 0.5 * len(want)

    single = stage(near(spark, clean, data), "t")
    _, component = brute_links(want)
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(set(component.values()))

    mixed = stage(mix(spark, single, data), "t")
    used, _ = brute_mix([(r["doc_id"], r["source"], len(WORD.findall(r["text"]))) for r in single.collect()])
    assert collections.Counter(r["doc_id"] for r in mixed.collect()) == collections.Counter({i: n * e for (i, _, _, e), n in used.items() if e})

    library = bpe.Vocabulary(bpe.tokenizer_file()).whole
    expected = collections.Counter()
    for r in mixed.collect():
        ids = library.encode(r["text"], add_special_tokens=False).ids
        expected[(r["doc_id"], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())] += 1
    assert collections.Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"]) for r in encode(spark, mixed, data).collect()) == expected
    whole = corpus_pipeline.run(spark, data)
    assert collections.Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"]) for r in whole.collect()) == expected


def test_empty_documents(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_odd_columns(spark, tmp_path):
    rows = [(1, None, None, None), (2, "", "en", "s"), (3, "ten words are enough for a text that stays in here " * 1 + "now", "en", None), (3, "ten words are enough for a text that stays in here now", "en", None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text").cast("long")).write.parquet(str(tmp_path / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in got} == {3}


def test_repeated_rows_and_null_sources(spark, tmp_path):
    """Copies of a row, in a source and without one: one of each stays after the near duplicates, and none is lost."""
    text = lambda k: " ".join(f"word{'abcdefghij'[(k * 7 + i) % 10]}{'klmnop'[(k + i * i) % 6]}{'qrstuvw'[(k * i) % 7]}" for i in range(40))
    rows = [(k, text(k + 1), "en", "s" if k % 2 else None) for k in range(6)] + [(1, text(2), "en", "s")] * 30 + [(None, text(90), None, None)] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text").cast("long"))
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = collections.Counter(r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    assert set(got) <= {None, *range(6)} and all(n <= 3 for n in got.values())
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, apply in corpus_pipeline.STAGES[:3]:
        docs = stage(apply(spark, docs, str(tmp_path)), "t")
    counts = collections.Counter(r["doc_id"] for r in docs.collect())
    assert counts == {None: 1, **dict.fromkeys(range(6), 1)}
