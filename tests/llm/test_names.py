"""Input columns of any name keep their values in every operator and pipeline stage that returns them."""

import pytest

import corpus_pipeline
from strata.llm import html_text, line_dedup, mixing, quality_rules, simhash

from . import cases

ODD = ["a.b", "__id", "__l", "__size", "__row", "__hash", "__key", "__q", "__t", "__n", "__void", "key", "fp", "row", "line", "root", "count"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in ODD)


def docs(spark):
    rng = __import__("random").Random(3)
    rows = []
    for i in range(60):
        t = "\n".join(cases.sentence(rng, 25) for _ in range(2))
        rows.append((i, t, "en", "ab"[i % 2], len(t)))
    rows += [(60, rows[3][1], "en", "a", 5), (61, None, None, None, None), (None, "", "en", None, 0), (62, "x " * 30000, "en", "b", 60000)]
    return spark.createDataFrame([(*r, *[f"{c}-{r[0]}" for c in ODD]) for r in rows], SCHEMA)


def run(name, df, spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    return {"quality": lambda: quality_rules.keep_good(df, labels), "lines": lambda: line_dedup.without_repeats(df), "simhash": lambda: simhash.keep_first(df),
            "mix": lambda: mixing.mix_documents(df), "mixed": lambda: mixing.mix(df.drop("__size"), mixing.word_count(df["text"])),
            "dedup": lambda: line_dedup.dedup_lines(df), "html": lambda: html_text.extract_pages(df, "text")}[name]()


@pytest.mark.parametrize("name", ["quality", "lines", "simhash", "mix", "mixed", "dedup", "html"])
def test_columns_keep_names_and_values(spark, name):
    df = docs(spark)
    out = run(name, df, spark)
    want = [c for c in df.columns if name != "mixed" or c != "__size"]
    assert out.columns[:len(want)] == want and len(out.columns) == len(want) + {"mixed": 4, "dedup": 3, "html": 1}.get(name, 0)
    rows = out.collect()
    assert rows
    for r in rows:
        for c in ODD:
            if c in want:
                assert r[c] == f"{c}-{r['doc_id']}", (name, c)
    assert run(name, df.limit(0), spark).count() == 0


def test_names_of_added_columns_are_refused(spark):
    df = docs(spark)
    with pytest.raises(ValueError, match="__size"):
        mixing.mix(df, mixing.word_count(df["text"]))


def test_many_rows_without_id_have_keys_of_their_own(spark):
    df = spark.createDataFrame([(None, f"text {i}", "s") for i in range(300)], "doc_id long, text string, source string")
    keys = df.select(mixing.random_key(df["doc_id"], 17, df["text"]).alias("k"))
    assert keys.distinct().count() == 300
    assert mixing.mix(df, mixing.word_count(df["text"]), text=df["text"]).groupBy().sum("__taken").first()[0] == 600


def test_stages_of_the_pipeline_on_odd_input(spark):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs(spark), "/root/testdata/sf0.001")
        assert out.count() > 0, name
        assert stage(spark, docs(spark).limit(0), "/root/testdata/sf0.001").count() == 0, name
        if name != "sentencepiece":
            assert out.columns == docs(spark).columns, name
