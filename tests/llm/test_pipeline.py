"""The corpus pipeline as a whole and stage by stage, on small tables with nulls, empty texts, repeats and an empty table."""

import re

import pytest

import corpus_pipeline
from trackloom.llm import pii

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def texts():
    body = [" ".join(f"w{i}x{(i * 7 + k * k) % 53}" for k in range(60)) for i in range(60)]
    out = dict(enumerate(body))
    out |= {100 + i: body[i] + " vilest slurish" for i in range(30)}
    out |= {200: body[3], 201: body[3].replace(" ", "\n", 5), 202: body[4] + " tail", 203: "mail jane.doe@corp.com now", 204: None, 205: "", 206: " ", 207: body[4] + " tail"}
    return out


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("corpus"))
    rows = [(i, t, "en" if i % 5 else None, "s" if i % 7 else None, None) for i, t in texts().items()]
    docs = spark.createDataFrame([*rows, rows[0], (None, "a row without id", None, None, None)], SCHEMA)
    docs.write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(i, 1, int(100 <= i < 200)) for i in texts() if i % 2 or i < 10], "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return root


def test_each_stage_takes_effect(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    sound = stages["toxicity"](spark, docs, tables)
    assert sound.columns == docs.columns
    ids = {r.doc_id for r in sound.collect()}
    assert ids == {r.doc_id for r in docs.collect()} - {i for i in texts() if 100 <= i < 200}

    single = stages["exact_dedup"](spark, sound, tables)
    norm, want = set(), []
    for i, t in sorted((i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t in texts().items() if i in ids):
        if t not in norm:
            norm.add(t)
            want.append(i)
    got = [r.doc_id for r in single.collect()]
    assert sorted(i for i in got if i is not None) == want and None in got and single.columns == docs.columns

    near = stages["near_dedup"](spark, single, tables)
    sets = {}
    for i in want:
        w = WORDS.findall((texts()[i] or "").lower())
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())
    keep = []
    for i in want:  # groups here are stars: a copy is near the one that stays
        if not any(sets[i] and 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j]) for j in keep):
            keep.append(i)
    assert sorted(r.doc_id for r in near.collect() if r.doc_id is not None) == keep and 202 not in keep
    assert near.columns == docs.columns

    plain = stages["pii"](spark, near, tables)
    assert plain.columns == docs.columns
    key = pii.session_key(spark)
    for r in plain.collect():
        old = texts().get(r.doc_id, "a row without id")
        spans = pii.find(old or "")
        new = old if not spans else old[: spans[0][0]] + pii.pseudonym(spans[0][2], old[slice(*spans[0][:2])], key) + old[spans[0][1] :]
        assert r.text == new and r.n_chars == (None if new is None else len(new))

    packed = stages["packing"](spark, plain, tables).collect()
    assert sorted({r.doc_id for r in packed if r.doc_id is not None}) == keep
    ends = {}
    for r in sorted(packed, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    bins = []  # plain best fit, longest first
    for n in sorted((r.length for r in packed), reverse=True):
        fit = min((b for b in range(len(bins)) if bins[b] + n <= 2048), key=lambda b: 2048 - bins[b] - n, default=None)
        if fit is None:
            bins.append(n)
        else:
            bins[fit] += n
    assert max(ends.values()) <= 2048 and len(ends) <= len(bins)


def test_run_equals_the_stages_and_leaves_one_table(spark, tables):
    import os

    from trackloom.llm import common

    root = common.scratch_root(spark).removeprefix("file://")
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    got = corpus_pipeline.run(spark, tables)
    assert {x.split("-")[0] for x in set(os.listdir(root)) - before} == {"stage"} and len(set(os.listdir(root)) - before) == 1
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, tables)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(str, got.select(key).collect())) == sorted(map(str, docs.select(key).collect()))


def test_empty_table(spark, tables, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{tables}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
