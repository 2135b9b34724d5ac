"""Each stage of the pipeline against a brute-force version on what its predecessor kept."""

import os
import re
from collections import Counter

import pytest

import corpus_pipeline
from quirework.llm import mixing, toxicity
from test_operators import LARGER as FOLDER
from test_operators import TEXTS, best_capacity, brute_components, brute_prints, words

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def stages(spark):
    from quirework.llm.common import stored

    docs, kept = spark.read.parquet(f"{FOLDER}/documents.parquet"), {}
    kept["documents"] = docs
    for name, stage in corpus_pipeline.STAGES:
        docs = kept[name] = stored(stage(spark, docs, FOLDER))
    return kept


def rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_columns_and_order(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash", "decontamination", "mixing", "sharding"]
    for name in list(stages)[:-1]:
        assert stages[name].columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_toxicity(spark, stages):
    scored = toxicity.score_toxicity(stages["documents"], spark.read.parquet(f"{FOLDER}/labels.parquet"))
    stay = {r["doc_id"] for r in scored.filter("predicted = 0").collect()}
    assert set(rows(stages["toxicity"])) == stay and 0 < len(stay) < stages["documents"].count()


def test_near_copies(stages):
    before, after = rows(stages["toxicity"]), set(rows(stages["simhash"]))
    ids = sorted(before)
    parts = brute_components(ids, brute_prints([before[i]["text"] for i in ids]))
    assert after == {i for i, c in zip(ids, parts) if i == c}


def test_contamination(spark, stages):
    fold = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
    windows = set()
    for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect():
        w = fold(r["text"])
        windows |= {" ".join(w[i : i + 10]) for i in range(max(1, len(w) - 9))}
    clean = set()
    for i, r in rows(stages["simhash"]).items():
        w = fold(r["text"])
        if not windows & {" ".join(w[k : k + 10]) for k in range(max(0, len(w) - 9))}:
            clean.add(i)
    assert set(rows(stages["decontamination"])) == clean


def test_mix(stages):
    before, taken = rows(stages["decontamination"]), Counter(r["doc_id"] for r in stages["mixing"].collect())
    sized = stages["decontamination"].select("doc_id", "source", mixing.word_count(stages["decontamination"]["text"]).alias("size"))
    want = {r["doc_id"]: r["copies"] for r in mixing.mix(sized).collect()}
    assert {i: want[i] for i in want if want[i]} == dict(taken) and set(want) == set(before)
    assert all(r["size"] == len(words(before[r["doc_id"]]["text"])) for r in sized.collect())


def test_shards(stages):
    placed = stages["sharding"].collect()
    assert len(placed) == stages["mixing"].count()
    slots, load, groups = {}, Counter(), Counter()
    for r in placed:
        slots.setdefault(r["shard"], []).append(r["slot"])
        load[r["shard"]] += r["size"]
        groups[r["text"]] += r["size"]
    import hashlib

    order = sorted(groups, key=lambda t: hashlib.sha256(t.encode()).hexdigest())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(load.values()) == best_capacity([groups[t] for t in order], 16)


def test_odd_rows_pass_every_stage(spark, tmp_path):
    folder = str(tmp_path)
    docs = [(i, t, None, None, None, "clash") for i, t in TEXTS]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long, shard string").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (2, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, "ü ö ä ß 漢 字 é")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    found = [r["doc_id"] for r in corpus_pipeline.run(spark, folder).collect()]
    assert found and 11 not in found and set(found) <= {i for i, _ in TEXTS}


def test_rows_without_or_with_one_id_survive(spark, tmp_path):
    """Rejected and near-equal rows take no other row of their id, or without one, with them."""
    folder, spoiled = str(tmp_path), "one two three four five six seven eight nine ten eleven"
    plain = [f"this is the {w} plain and quite different text about {w} things and {v}" for w, v in zip("red green blue grey black white".split(), "cats dogs birds fish cows hens".split())]
    rows = [(None, plain[0]), (None, spoiled), (None, plain[1]), (7, plain[2]), (7, plain[3]), (7, spoiled), (8, plain[4]), (None, plain[4]), (9, plain[5]), (9, plain[5]), (None, plain[0])]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(1, spoiled)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    kept = corpus_pipeline.drop_contaminated(spark, corpus_pipeline.drop_near_copies(spark, docs, folder), folder)
    want = [(None, plain[0]), (None, plain[1]), (7, plain[2]), (7, plain[3]), (8, plain[4]), (9, plain[5])]
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr) == sorted(want, key=repr)
    assert kept.columns == corpus_pipeline.COLUMNS


def test_empty_corpus(spark, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0
