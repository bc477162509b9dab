"""Quality classifier, language identification."""

import numpy as np
import zstandard

from loanmeter.llm import rule_ensemble, zstd_language
from loanmeter.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_quality_on_held_out_rows(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    found = QUERIES["op5_quality_classifier"](spark, SF)
    assert found.count() == 1000 and found.where("score < 0 or score > 1 or score is null").count() == 0
    held = found.where("held_out").join(labels, "doc_id")
    assert held.where("predicted = quality").count() >= 0.95 * held.count()


def test_rules_are_sparse_and_compiled(spark):
    texts = [(i, "good words stand here in a row %d" % i if i % 2 else "BAD!! " * 9) for i in range(200)]
    docs = spark.createDataFrame([*texts, (900, None), (901, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(5, None)], "doc_id long, quality int")
    statistics = rule_ensemble.text_statistics(docs)
    rules = rule_ensemble.EnsembleRules(trees=5)
    model = rule_ensemble.fit(rule_ensemble.labelled_sample(statistics, labels, "quality", rules), rules)
    assert 0 < len(model.rules) < 5 * 14
    scored = {r.doc_id: r.s for r in statistics.select("doc_id", model.score().alias("s")).collect()}
    assert all((scored[i] > 0.5) == bool(i % 2) for i in range(200)) and 0 <= scored[900] == scored[901] <= 1
    nothing = rule_ensemble.fit(rule_ensemble.labelled_sample(statistics, labels.limit(0), "quality", rules), rules)
    assert statistics.select(nothing.score().alias("s")).first().s == 0.5


def test_compiled_rules_hold_where_the_rules_hold(spark):
    """The Spark expression gives what the rules say of the statistics, on whole documents."""
    statistics = rule_ensemble.text_statistics(spark.read.parquet(f"{SF}/documents.parquet"))
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = rule_ensemble.fit(rule_ensemble.labelled_sample(statistics, labels, "quality", rule_ensemble.EnsembleRules()))
    found = statistics.withColumn("score", model.score()).toPandas()
    x = found[list(rule_ensemble.STATISTICS)].to_numpy(float)
    margin = model.intercept + sum(rule.weight * rule.holds(x) for rule in model.rules)
    assert len(model.rules) > 3 and abs(found["score"].to_numpy() - 1 / (1 + np.exp(-margin))).max() < 1e-12


def test_a_hot_id_does_not_enlarge_the_sample(spark):
    texts = [(i, "good words stand here in a row %d" % i) for i in range(40)] + [(7, "BAD!! " * (i % 9)) for i in range(500)]
    docs = spark.createDataFrame([*texts, (None, "x")], "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(7, 0)] * 300 + [(99, 1), (None, 1), (3, None)], "doc_id long, quality int")
    statistics = rule_ensemble.text_statistics(docs)
    for most in (20_000, 15):
        sample = rule_ensemble.labelled_sample(statistics, labels, "quality", rule_ensemble.EnsembleRules(sample_rows=most)).collect()
        assert len(sample) == min(most, 40) == len({r.doc_id for r in sample})
        assert all(r.y == r.doc_id % 2 for r in sample)


def test_dictionaries_of_few_long_texts(spark):
    """Every language with a letter has content, bounded bytes are gathered, and number signs are no letters."""
    rules = zstd_language.LanguageRules(dictionary_bytes=3000, all_bytes=9000, piece_chars=500)
    rows = [(1, "the and of to in " * 20_000, "en"), (2, "\u00bd \u00b2 \u2460", "signs"), (3, None, "none")]
    rows += [(10 + i, "der und die das " * 50, "de") for i in range(400)] + [(None, "le la les " * 9, "fr"), (5, "un", None)]
    train = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    pieces = zstd_language.language_samples(train, rules).collect()
    assert sum(len(r.piece.encode()) for r in pieces) <= 3 * (3000 + 500)
    found = zstd_language.learn_dictionaries(train, rules)
    assert found.keys() == {"en", "de", "fr"} and all(0 < len(x) <= 3000 for x in found.values())
    docs = spark.createDataFrame([(1, "\u00bd \u00b2 \u2460"), (2, "\u00e9"), (3, "the and of to in the and of to in the and of"), (4, "der und die das der und die das")], "doc_id long, text string")
    guess = {r.doc_id: r.lang_pred for r in zstd_language.identify(docs, found).collect()}
    assert guess[1] == "und" and guess[2] != "und" and (guess[3], guess[4]) == ("en", "de")


def test_languages_against_one_frame_after_the_other(spark):
    """The kernel against zstandard called plainly, block by block."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    dictionaries = zstd_language.learn_dictionaries(docs.where("doc_id % 2 = 0"))
    some = docs.where("doc_id < 60").select("doc_id", "text").collect()
    found = {r.doc_id: r.lang_pred for r in zstd_language.identify(docs.where("doc_id < 60"), dictionaries).collect()}
    for r in some:
        data = zstd_language.plain(r.text or "").encode()
        sizes = {}
        for lang, content in dictionaries.items():
            own = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            coder = zstandard.ZstdCompressor(level=6, dict_data=own, write_content_size=False, write_dict_id=False)
            sizes[lang] = sum(len(coder.compress(data[i : i + 2048])) for i in range(0, len(data), 2048))
        best = min(sizes.values())
        winners = [lang for lang, size in sorted(sizes.items()) if size == best]
        assert len(winners) > 1 or found[r.doc_id] == winners[0] or not r.text


def test_languages_of_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held = QUERIES["op10_language"](spark, SF).where("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    assert held.where("lang = lang_pred").count() >= 0.95 * held.count()


def test_texts_without_language(spark):
    train = spark.createDataFrame([(1, "the and of to in", "en"), (2, "der und die das", "de"), (3, "x", None)], "doc_id long, text string, lang string")
    dictionaries = zstd_language.learn_dictionaries(train)
    assert dictionaries.keys() == {"en", "de"}
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "12 !?"), (4, "the and of to in"), (4, "the and of to in")], "doc_id long, text string")
    found = zstd_language.identify(docs, dictionaries).orderBy("doc_id").collect()
    assert [r.lang_pred for r in found] == ["und", "und", "und", "en", "en"]
    assert zstd_language.identify(docs, {}).where("lang_pred <> 'und'").count() == 0
