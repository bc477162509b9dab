from collections import defaultdict
from pathlib import Path

import __spark_entry__ as contract
import corpus_pipeline
import public_tokenizers
import tiktoken
from loanmeter.llm.byte_bpe import read_ranks
from loanmeter.llm.queries import RANKS
from loanmeter.llm.shared_tables import shared_folder
from pyspark.sql import functions as F
from tests.llm import plain
from tests.llm.test_mixing import targets
from tests.llm.test_repetition import texts

SF = "/root/testdata/sf0.001"


def test_all_queries_are_registered():
    names = contract.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)) and "pipeline" in names


def run_stages(spark, docs, sf=SF):
    """Each stage's input and output, as rows; every stage but the last keeps the columns."""
    columns, steps = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, sf).cache()
        steps[name] = (before.collect(), docs.collect())
        assert name == "tokens" or docs.columns == columns
    return steps


def check_stages(steps):
    before, after = steps["quality_rules"]
    assert {r.doc_id for r in after} <= {r.doc_id for r in before}
    assert all(r in before and len(plain.words(r.text)) >= 20 for r in after)

    before, after = steps["near_dedup"]
    tops = plain.near_components([(r.doc_id, r.text) for r in before if r.doc_id is not None], 80, 5)
    stay = [r for r in before if r.doc_id is None or tops[r.doc_id] == r.doc_id]
    assert sorted(map(str, after)) == sorted(map(str, stay))

    before, after = steps["suffix_dedup"]
    assert len(after) == len(before)
    left = {r.doc_id: r.text for r in after}
    assert len(left) == len(after)  # ids are unique here
    order = {r.doc_id: r for r in before}
    rows = [((-(1 << 63) if i is None else i,), r.text or "") for i, r in order.items()]
    expected = plain.without_passages(rows)
    assert all((left[i] or "") == expected[(-(1 << 63) if i is None else i,)] for i in left)
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in after)

    before, after = steps["mix_sources"]
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in before:
        sizes[r.source] += len(plain.words(r.text))
    for r in after:
        taken[r.source] += len(plain.words(r.text))
    goal = targets(sizes) if any(sizes.values()) else {}
    assert all(abs(taken[s] - goal[s]) <= 0.5 for s in goal)
    whole = {r.doc_id: r.text for r in before}
    assert all(whole[r.doc_id].startswith(r.text) for r in after)

    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(read_ranks(RANKS))}, special_tokens={}
    )
    before, after = steps["tokens"]
    expected = sorted((str(r.doc_id), library.encode_ordinary(r.text)) for r in before)
    assert sorted((str(r.doc_id), r.ids) for r in after) == expected
    assert all(r.n_tokens == len(r.ids) for r in after)


def test_stages_against_plain_versions(spark):
    steps = run_stages(spark, spark.read.parquet(f"{SF}/documents.parquet"))
    assert all(len(after) > 50 for _, after in steps.values())
    check_stages(steps)


def test_stages_on_odd_rows_and_clashing_columns(spark):
    """Nulls, empty, long and equal texts; columns named like those that the operators add."""
    many = [*texts(), " ".join(f"w{i}" for i in range(30_000)), " ".join(f"w{i}" for i in range(29_000)), "x" * 300_000 + " y" * 25]
    many += [" ".join(f"v{i}" for i in range(40))] * 3
    rows = [(i, t, "en", "s" if i % 2 else None, 1) for i, t in enumerate(many)]
    rows += [(None, " ".join(f"u{i}" for i in range(60)), None, None, None), (5000, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    clashing = ("row_hash", "spans0", "words1", "of_doc", "of_row", "node", "component", "kept", "size", "key", "content", "last", "cut_row", "epoch", "doc")
    docs = docs.withColumns({name: F.lit(name) for name in clashing})
    steps = run_stages(spark, docs)
    check_stages(steps)
    assert len(steps["quality_rules"][1]) > 5 and len(steps["near_dedup"][1]) < len(steps["near_dedup"][0])


def test_stages_on_empty_tables(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for rows in ([], [(None, None, None, None, None)] * 2, [(1, "", "", "", 0)]):
        steps = run_stages(spark, spark.createDataFrame(rows, schema))
        assert all(after == [] for _, after in steps.values())


def test_intermediate_tables_go_with_their_stage(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(40)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    folder = Path(shared_folder(spark).removeprefix("file:"))
    before = set(folder.iterdir()) if folder.exists() else set()
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert {x.name.split("-")[0] for x in set(folder.iterdir()) - before} == {name for name, _ in corpus_pipeline.STAGES}
    assert out.count() > 10
