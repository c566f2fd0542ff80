"""Each operator beside its plain version, on the given table and on one of odd rows; and on an empty one."""

import hashlib
from collections import defaultdict

import brute
import pytest

from eventmill.llm import exact_dedup, licenses, lm_scoring, mixing, near_dedup, packing, quality, repeats, resampling


def pairs(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


def ordered(rows):
    return sorted([tuple(r) for r in rows], key=repr)


def test_quality_statistics(docs, labels):
    found = quality.judge(docs, quality.trusted_ids(labels)).collect()
    assert ordered(r[:7] for r in found) == ordered(brute.quality(pairs(docs)))
    assert all(not r["kept"] for r in found if r["base_failed"]) and all(r["score"] is None for r in found if not r["n_words"])
    assert all(r["kept"] == (r["score"] >= quality.THRESHOLD) for r in found if not r["base_failed"])


def test_quality_separates_labelled_documents(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    found = quality.judge(spark.read.parquet(f"{folder}/documents.parquet"), quality.trusted_ids(labels))
    judged = found.where("not base_failed").join(labels, "doc_id").collect()
    good, bad = [r["kept"] for r in judged if r["quality"] == 1], [r["kept"] for r in judged if r["quality"] == 0]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.1 * len(bad)


def test_quality_counts_match_by_hand(spark, odd):
    import numpy as np

    ids = spark.createDataFrame([(10,), (11,)], "doc_id long")
    found = quality.log_ratios(odd, ids)
    counts = np.ones((2, quality.BUCKETS))
    for doc_id, text in pairs(odd):
        bucket = quality.buckets([(text or "").encode()])[2]
        np.add.at(counts[0], bucket, 1)
        np.add.at(counts[1], bucket, int(doc_id in (10, 11)))
    by_hand = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    assert np.allclose(found, by_hand)


def test_without_trusted_texts_the_limits_decide(odd, nothing_trusted):
    assert all(r["kept"] == (not r["base_failed"]) and r["score"] is None for r in quality.judge(odd, nothing_trusted).collect())


def index(spark, prefix):
    return exact_dedup.DigestIndex(spark, f"{prefix}index", buckets=4)


def test_an_index_has_buckets_for_its_first_batch_and_keeps_them(spark, prefix, monkeypatch):
    monkeypatch.setattr(exact_dedup, "ROWS_A_BUCKET", 3)
    own, schema = index(spark, prefix + "sized"), "doc_id long, text string"
    for start in (0, 10):
        own.add(spark.createDataFrame([(i, f"text {i}") for i in range(start, start + 20)], schema))
        buckets = spark.sql(f"DESCRIBE TABLE EXTENDED {own.table}").where("col_name = 'Num Buckets'").first()["data_type"]
        assert buckets == "8"
    assert sorted(r["keep_id"] for r in own.read().collect()) == list(range(30))


def test_exact_dedup(spark, prefix, docs):
    rows, groups = pairs(docs), defaultdict(list)
    for i, t in rows:
        groups[hashlib.sha256((t or "").translate(brute.LOWER).encode()).hexdigest()].append(i)
    expected = []
    for h, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        expected += [(i, keep, len(ids), i == keep, h) for i in ids]
    assert ordered(exact_dedup.verdicts(index(spark, prefix), docs).collect()) == ordered(expected)


def test_index_keeps_what_came_first_and_joins_without_a_shuffle(spark, prefix):
    own = index(spark, prefix)
    schema = "doc_id long, text string"
    first = exact_dedup.verdicts(own, spark.createDataFrame([(1, "A"), (2, "b")], schema))
    assert {r["doc_id"]: r["keep_id"] for r in first.collect()} == {1: 1, 2: 2}
    second = exact_dedup.verdicts(own, spark.createDataFrame([(7, "a"), (8, "c"), (9, "C"), (3, "b")], schema)).collect()
    assert {r["doc_id"]: (r["keep_id"], r["kept"]) for r in second} == {7: (1, False), 8: (9, False), 9: (9, True), 3: (2, False)}
    assert own.read().count() == 3 == own.read().select("digest").distinct().count()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = own.read().select("digest").groupBy("digest").count()._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan
    left = exact_dedup.distinct(index(spark, prefix + "x"), spark.createDataFrame([(1, "q"), (2, "Q"), (3, None)], schema))
    assert ordered(left.collect()) == [(2, "Q"), (3, None)]


def test_lm_base(docs):
    found = lm_scoring.score(docs).collect()
    expected = brute.lm(pairs(docs))
    assert ordered(r[:5] for r in found) == ordered(x[:5] for x in expected)
    assert sorted(r["base_score"] for r in found) == pytest.approx(sorted(x[5] for x in expected), rel=1e-9)
    assert all(r["score"] <= 0 for r in found)


def test_lm_beats_single_words_on_held_out_text(spark):
    found = lm_scoring.score(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).where("held_out").collect()
    assert sum(r["score"] for r in found) > sum(r["base_score"] for r in found)


def test_filter_counts_are_never_too_low():
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(1)
    grams, counts = rng.integers(0, 2**63, 4000).astype(np.uint64), rng.integers(1, 3000, 4000)
    parts = []
    for shard in range(4):
        own = grams % np.uint64(4) == shard
        numbers = counts[own].astype(np.uint32).tobytes()
        rows = [(shard, 1, grams[own].tobytes(), numbers), (shard, 2, lm_scoring.prints(grams[own]).tobytes(), numbers)]
        parts.append(lm_scoring.built(1 << 24)(pd.DataFrame(rows, columns=["shard", "n", "grams", "counts"]))["bits"][0])
    sizes = np.array([len(p) * 8 for p in parts])
    found = lm_scoring.Filter(np.frombuffer(b"".join(parts), np.uint8), np.cumsum(sizes) - sizes, sizes.astype(np.uint64))
    least = lm_scoring.BASE ** (lm_scoring.levels(counts) - 1.0)
    other = rng.integers(0, 2**63, 4000).astype(np.uint64)
    for order in (0, 1):
        read = found.counts(order, grams)
        assert (read >= least).all() and (read == least).mean() > 0.94
        assert (found.counts(order, other) > 0).mean() < 0.05


def test_packing(docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    packed = packing.pack(docs, with_ids=True)
    found = packed.collect()
    assert ordered((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found) == ordered(
        brute.pieces(pairs(docs), lambda t: tokenizer.encode(t, add_special_tokens=False).ids)
    )
    bins = defaultdict(list)
    for r in found:
        bins[r["sequence_id"]].append((r["offset"], r["length"], bytes(r["ids"])))
    for own in bins.values():
        own.sort()
        assert [o for o, _, _ in own] == [sum(n for _, n, _ in own[:i]) for i in range(len(own))] and sum(n for _, n, _ in own) <= 1024
        assert sum(3 * n > 1024 for _, n, _ in own) <= 2
    assert len(bins) <= 1.05 * sum(r["length"] for r in found) / 1024 + 2
    whole = {r["sequence_id"]: bytes(r["ids"]) for r in packing.sequences(packed).collect()}
    assert sorted(map(len, whole.values())) == sorted(4 * sum(n for _, n, _ in own) for own in bins.values())


def test_plan_fits_any_counts():
    import random
    from collections import Counter

    random.seed(3)
    for _ in range(150):
        capacity = random.choice([7, 16, 60, 100])
        counts = Counter(random.randint(1, capacity) for _ in range(random.randint(0, 300)))
        used, got = Counter(), Counter()
        for run in packing.plan(counts, capacity):
            for k in range(run.count):
                used[run.sequence + k // run.per] += run.length
                got[run.length] += 1
        assert got == counts and all(n <= capacity for n in used.values())


@pytest.mark.parametrize("family", [512, 1])
def test_near_groups(docs, monkeypatch, family):
    monkeypatch.setattr(near_dedup, "FAMILY", family)
    monkeypatch.setattr(near_dedup, "CHUNK", 512 if family > 1 else 2)
    assert ordered(near_dedup.near_groups(docs).collect()) == ordered(brute.near(pairs(docs)))


@pytest.mark.parametrize("leaders", [1, 4])
def test_near_groups_of_drifting_copies(spark, monkeypatch, leaders):
    """Chains whose ends are no links, copies of one text, and a text of its own, met in chunks of two with few leaders."""
    import random

    random.seed(11)
    monkeypatch.setattr(near_dedup, "FAMILY", 1)
    monkeypatch.setattr(near_dedup, "CHUNK", 2)
    monkeypatch.setattr(near_dedup, "LEADERS", leaders)
    rows = []
    for chain in range(3):
        words = [f"c{chain}w{i}" for i in range(200)]
        for step in range(10):
            words[random.randrange(200)] = f"c{chain}s{step}"
            rows.append((100 * chain + step, " ".join(words)))
    plain = [f"p{i}" for i in range(150)]
    rows += [(1000 + i, " ".join([*plain[: 5 * i], f"x{i}", *plain[5 * i + 1 :]])) for i in range(20)]
    rows.append((2000, " ".join(f"q{i}" for i in range(80))))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = near_dedup.near_groups(docs).collect()
    assert ordered(found) == ordered(brute.near(rows))
    assert len({r["component_id"] for r in found}) < len(rows)


def test_one_of_each(odd):
    rows = {(r["doc_id"], r["text"]) for r in near_dedup.one_of_each(odd).collect()}
    kept = {(x[0], t) for x, (_, t) in zip(brute.near(pairs(odd)), pairs(odd)) if x[3]}
    assert rows == kept and near_dedup.one_of_each(odd).columns == odd.columns


def test_super_minhash_estimates_similarity():
    import numpy as np

    rng = np.random.default_rng(5)
    elements = rng.integers(0, 2**63, 1000).astype(np.uint64)
    a, b = elements[:900], elements[100:]
    signature = near_dedup.super_minhash(np.concatenate((a, b)), np.repeat([0, 1], 900), 2, 256)
    assert abs((signature[0] == signature[1]).mean() - 0.8) < 0.08
    assert (np.sort(np.floor(near_dedup.super_minhash(elements[:1], np.zeros(1, np.int64), 1, 64)[0])) == np.arange(64)).all()


def test_repeats(docs):
    found = repeats.repeats(docs).collect()
    assert ordered(r[:5] for r in found) == ordered(brute.repeats(pairs(docs)))
    texts = defaultdict(set)
    for i, t in pairs(docs):
        texts[i].add((t or "").encode())
    for r in found:
        spans = [(s["start"], s["end"]) for s in r["spans"]]
        cuts = [0, *[x for s in spans for x in s]]
        assert len(spans) == r["n_spans"] and any(
            b"".join(t[a:b] for a, b in zip(cuts[::2], [*cuts[1::2], len(t)])) == bytes(r["kept"]) for t in texts[r["doc_id"]]
        )


@pytest.mark.parametrize("length", [4, 12, 50])
def test_repeats_in_many_blocks(odd, monkeypatch, length):
    monkeypatch.setattr(repeats, "BLOCK_BYTES", 4000)
    monkeypatch.setattr(repeats, "SHARD_BYTES", 3000)
    assert ordered(r[:5] for r in repeats.repeats(odd, length).collect()) == ordered(brute.repeats(pairs(odd), length))


def test_mixing(odd):
    found = mixing.mix(odd).collect()
    sizes = defaultdict(int)
    for r in found:
        sizes[r["source"]] += r["size"]
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    target, free, budget = {}, set(order), 1.5 * sum(sizes.values())
    while True:
        level = (budget - sum(target.values())) / sum(weight[s] for s in free) if free else 0
        over = {s for s in free if level * weight[s] > 2 * sizes[s]}
        target |= {s: 2.0 * sizes[s] for s in over}
        free -= over
        if not over:
            break
    target |= {s: level * weight[s] for s in free}
    taken = defaultdict(int)
    for r in found:
        assert r["target"] == pytest.approx(target[r["source"]]) and r["source_size"] == sizes[r["source"]]
        assert r["taken"] == r["size"] * r["copies"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    longest = max(r["size"] for r in found)
    assert all(target[s] - longest <= taken[s] <= target[s] + 1e-6 for s in order)
    rows = mixing.mixed(odd)
    assert rows.columns == odd.columns and rows.count() == sum(r["copies"] for r in found)
    assert ordered(mixing.mix(odd.repartition(5)).collect()) == ordered(found)


def test_licenses(docs):
    found = licenses.scan(docs).collect()
    got = [(r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], ",".join(r["base_labels"])) for r in found]
    assert ordered(got) == ordered(brute.base_licenses(pairs(docs)))
    assert all(set(r["base_labels"]) <= set(r["labels"]) and 0 <= r["score"] <= 1 and r["labels"] == sorted(set(r["labels"])) for r in found)


def test_license_rules_resolve_overlaps(spark):
    texts = {
        1: "Licensed under the Apache License, Version 2.0.", 2: "under the GNU Lesser General Public License v2.1 or later", 3: "CC-BY-SA 4.0", 4: "SPDX-License-Identifier: BSD-3-Clause",
        5: "Permission is hereby granted, free of charge, to any person obtaining a copy", 6: "© copyright 2019 all rights reserved", 7: "the plain word permission to go",
    }
    found = {r["doc_id"]: r for r in licenses.scan(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert found[1]["labels"] == ["apache", "apache-2.0"] and found[1]["score"] >= 0.9
    assert found[2]["labels"] == ["lgpl-2.1"] and "cc-by-sa-4.0" in found[3]["labels"] and "cc-by-sa" not in found[3]["labels"]
    assert found[4]["labels"] == ["bsd-3"] and found[5]["labels"] == ["mit"] and "copyright" in found[6]["labels"] and found[7]["labels"] == []
    assert len(licenses.rules()) > 200


def test_resampling(docs, labels):
    found = resampling.resample(docs, quality.trusted_ids(labels), 0.25).collect()
    k = int(0.25 * len(found))
    sampled = [r for r in found if r["sampled"]]
    assert k - 4 <= len(sampled) <= k
    weight, variate = {}, {}
    for r in resampling.log_weights(docs, quality.trusted_ids(labels)).withColumn("g", resampling.gumbel("doc_id")).collect():
        weight[r["doc_id"]], variate[r["doc_id"]] = r["log_weight"], r["g"]
    if len(weight) == len(found):
        least = min(weight[r["doc_id"]] + variate[r["doc_id"]] for r in sampled)
        assert all(weight[r["doc_id"]] + variate[r["doc_id"]] < least for r in found if not r["sampled"])
    assert sum(r["sampled"] for r in resampling.resample(docs, quality.trusted_ids(labels), 1.0).collect()) == len(found)


def test_gumbel_top_k_follows_the_weights(spark):
    rows = spark.range(20000).selectExpr("id as doc_id", "if(id % 2 = 0, 2.0, 0.0) as w")
    total = rows.select("doc_id", (resampling.F.col("w") + resampling.gumbel(resampling.F.col("doc_id"))).alias("total"))
    least = resampling.threshold(total, 500)
    taken = [r["doc_id"] for r in total.where(total.total >= least).collect()]
    assert len(taken) == 500 and 0.82 < sum(i % 2 == 0 for i in taken) / 500 < 0.93


def test_empty_tables(spark, prefix, empty, nothing_trusted):
    frames = [
        quality.judge(empty, nothing_trusted), exact_dedup.verdicts(index(spark, prefix), empty), lm_scoring.score(empty), packing.pack(empty), near_dedup.near_groups(empty),
        repeats.repeats(empty), mixing.mix(empty), licenses.scan(empty), resampling.resample(empty, nothing_trusted), mixing.mixed(empty), near_dedup.one_of_each(empty),
        exact_dedup.distinct(index(spark, prefix + "x"), empty),
    ]
    assert [f.count() for f in frames] == [0] * len(frames)
