"""Input columns named like the operators' own ones come back unchanged or are replaced as stated."""

from pyspark.sql import functions as F

from shelterlens.llm import chat_format, mixing, quality_rules, substring_dedup

NAMES = ["_t", "_w", "_l", "_h", "_s", "_p", "_again", "_row", "_doc", "_own_kept", "kept", "base_failed", "n_words", "n_tokens",
         "probability", "_source", "_lang", "_topic", "__sd_id", "__sd_spans", "__sd_cut", "topic", "salt"]


def documents(spark):
    passage = " ".join(f"word{i} and the" for i in range(40))
    rows = [(i, f"start{i} the a of " * 12 + (passage if i < 6 else ""), "en", f"s{i % 2}") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return docs, docs.select("*", *[F.concat(F.lit(f"{c}-"), F.col("doc_id").cast("string")).alias(c) for c in NAMES])


def same_extras(out):
    names = [c for c in out.columns if c in NAMES]
    return all(r[c] == f"{c}-{r.doc_id}" for r in out.collect() for c in names) and names == NAMES


def test_filters_keep_every_column(spark):
    docs, wide = documents(spark)
    for keep in (quality_rules.keep_good, substring_dedup.without_repeats):
        out, plain = keep(wide), keep(docs)
        assert out.columns == wide.columns and same_extras(out)
        assert sorted(map(tuple, out.select("doc_id", "text").collect())) == sorted(map(tuple, plain.select("doc_id", "text").collect()))
    out = mixing.keep_mixed(wide)
    assert out.columns == wide.columns and same_extras(out)
    assert {r.doc_id for r in mixing.keep_mixed(wide.drop("topic")).collect()} == {r.doc_id for r in mixing.keep_mixed(docs).collect()}


def test_measures_replace_columns_of_their_names(spark):
    docs, wide = documents(spark)
    out = {r.doc_id: r for r in quality_rules.judged(wide).collect()}
    for r in quality_rules.judged(docs).collect():
        assert (out[r.doc_id].n_words, out[r.doc_id].kept, out[r.doc_id].base_failed) == (r.n_words, r.kept, r.base_failed)
        assert out[r.doc_id]._t == f"_t-{r.doc_id}" and out[r.doc_id]._p == f"_p-{r.doc_id}"
    probability = {r.doc_id: r.probability for r in mixing.sampled(docs).collect()}
    assert {r.doc_id: r.probability for r in mixing.sampled(wide.drop("topic")).collect()} == probability


def test_roles_come_back(spark):
    roles = ["a\x00b", "\\n", "\\", "x\ny", "\\\n", "<|im_end|>", "<\\|", "\\\\n\x00\n", "", "assistant"]
    rows = [(i, 0, role, f"t{i}") for i, role in enumerate(roles)]
    back = chat_format.read_back(chat_format.examples(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")))
    assert {r.conv_id: (r.turns[0].role, r.turns[0].text) for r in back.collect()} == {i: (role, f"t{i}") for i, role in enumerate(roles)}
