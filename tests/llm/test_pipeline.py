"""Each stage of the pipeline on small tables against plain Python: nulls, repeats, ties, planted copies and items."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import pytest

import corpus_pipeline
from strata.llm import langid, sharding
from strata.session import scratch_dir
from tests.llm.test_decontam import leaked

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ALPHABETS = {"en": "abcdefgh", "de": "stuvwxyzäö"}


def word(rng, lang):
    return "".join(rng.choice(ALPHABETS[lang]) for _ in range(rng.randint(2, 7)))


def corpus(seed=3):
    """Texts of two languages, copies and near copies of some, benchmark items in others, and odd rows."""
    rng = random.Random(seed)
    items = [(i, " ".join(word(rng, "en") for _ in range(14)) + ".") for i in range(4)]
    rows = []
    for i in range(90):
        lang = rng.choice(["en", "de"])
        tokens = [word(rng, lang) for _ in range(rng.randint(1, 120))]
        if i % 9 == 0:
            tokens[3:3] = items[i % 4][1].split()
        rows.append((i, " ".join(tokens), lang if i % 4 else None, rng.choice(["hot", "hot", "a", "b", None])))
    for i in range(0, 60, 4):  # one word in a hundred changed, or none
        tokens = rows[i][1].split()
        if len(tokens) > 60 and i % 8:
            tokens[30] = "changed"
        rows.append((200 + i, " ".join(tokens), rows[i][2], "copies"))
    rows += [(300, None, "en", "a"), (301, "", None, "a"), (302, "12 34 !", "en", None), (None, rows[1][1], "en", "a"), rows[5], rows[5]]
    return [(*r, 1) for r in rows], items


@pytest.fixture(scope="module")
def lake(spark):
    rows, items = corpus()
    path = scratch_dir(spark, "pipeline-test")
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, rows, items


def content(df):
    return Counter(map(tuple, df.collect()))


def plain_bayes(rows, text):
    """Posterior of the likeliest language from counts of the same hashed runs of characters, one by one."""
    counts, texts = {}, Counter()

    def grams(t):
        found = Counter()
        for chars, owners in langid._blocks([t]):
            for order in range(1, langid.ORDERS + 1):
                buckets = langid._buckets(chars, order)
                for place, bucket in enumerate(buckets.tolist()):
                    if owners[place] >= 0:
                        found[bucket] += 1
        return found

    for r in rows:
        if r[2] is not None:
            texts[r[2]] += 1
            counts.setdefault(r[2], Counter()).update(grams(r[1]))
    own = grams(text)
    if not own:
        return langid.UNKNOWN, 0.0
    logs = {}
    for lang, c in counts.items():
        total = sum(c.values()) + langid.SMOOTHING * langid.BUCKETS
        logs[lang] = math.log(texts[lang] / sum(texts.values())) + sum(n * math.log((c[b] + langid.SMOOTHING) / total) for b, n in own.items())
    best = max(sorted(logs), key=logs.get)
    return best, 1 / sum(math.exp(x - logs[best]) for x in logs.values())


def test_language(spark, lake):
    path, rows, _ = lake
    docs = spark.read.parquet(f"{path}/documents.parquet")
    kept = corpus_pipeline.identify_language(spark, docs, path)
    assert kept.columns == docs.columns
    want = Counter()
    for r in rows:
        lang, score = plain_bayes(rows, r[1]) if r[1] else (langid.UNKNOWN, 0.0)
        if lang != langid.UNKNOWN and score >= corpus_pipeline.CERTAIN:
            want[r] += 1
    assert content(kept) == want and len(want) < len(set(rows))
    scored = {r.doc_id: (r.lang_pred, r.score) for r in langid.with_language(docs, langid.fit(docs)).collect()}
    for r in rows[::7]:
        lang, score = plain_bayes(rows, r[1])
        assert scored[r[0]][0] == lang and scored[r[0]][1] == pytest.approx(score, abs=2e-3)


def shingles(text):
    tokens = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).split()
    return {tuple(tokens[i : i + 5]) for i in range(max(1, len(tokens) - 4))} if tokens else set()


def test_near_duplicates(spark, lake):
    path, rows, _ = lake
    docs = spark.read.parquet(f"{path}/documents.parquet")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, path)
    sets = [shingles(r[1]) for r in rows]
    group = list(range(len(rows)))
    for _ in rows:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and 100 * len(a & b) >= 80 * len(a | b):
                    group[i] = group[j] = min(group[i], group[j])
    want = Counter(r for r, s in zip(rows, sets) if not s)
    for g in {g for g, s in zip(group, sets) if s}:
        members = [r for r, x, s in zip(rows, group, sets) if x == g and s]
        want[min(members, key=lambda r: (r[0] is None, r[0] or 0))] += 1
    assert content(kept) == want and sum(want.values()) < len(rows) - 10


def test_decontamination(spark, lake):
    path, rows, items = lake
    kept = corpus_pipeline.decontaminate(spark, spark.read.parquet(f"{path}/documents.parquet"), path)
    assert content(kept) == Counter(r for r in rows if not leaked(r[1], items))
    assert sum(content(kept).values()) <= len(rows) - 10


def test_mixing(spark, lake):
    """Each source's copies come near its target, no row is taken more than three times, reruns agree."""
    path, rows, _ = lake
    docs = spark.read.parquet(f"{path}/documents.parquet")
    mixed = content(corpus_pipeline.mix_sources(spark, docs, path))
    assert mixed == content(corpus_pipeline.mix_sources(spark, docs.repartition(7), path))
    size = lambda r: len((r[1] or "").split())
    own = Counter()
    for r in rows:
        own[r[3]] += size(r)
    sources = sorted(own, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(sources)}
    target, left, open_ = {}, float(sum(own.values())), set(sources)
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level >= 3 * own[s]}
        for s in full or open_:
            target[s] = min(3 * own[s], weight[s] * level)
        left -= sum(target[s] for s in full)
        open_ = open_ - full if full else set()
    longest = max(map(size, rows))
    taken = Counter()
    times = Counter(rows)
    for r, n in mixed.items():
        assert r in times and n <= 3 * times[r]
        taken[r[3]] += n * size(r)
    assert all(abs(taken[s] - target[s]) <= longest for s in sources)


def test_sharding(spark, lake):
    path, rows, _ = lake
    docs = spark.read.parquet(f"{path}/documents.parquet")
    placed = corpus_pipeline.assign_shards(spark, docs, path)
    assert placed.columns == [*docs.columns, "shard"]
    found = {}
    for r in placed.collect():
        assert 0 <= r.shard < corpus_pipeline.SHARDS
        assert found.setdefault(r.doc_id, r.shard) == r.shard
    assert Counter(tuple(r)[:-1] for r in placed.collect()) == Counter(rows)


def test_run_reads_each_stage_from_the_one_before(spark, lake):
    path, rows, _ = lake
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "decontamination", "mixing", "sharding"]
    out = corpus_pipeline.run(spark, path)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "shard"]
    assert {tuple(r)[:-1] for r in out.collect()} <= set(rows)


def test_empty_documents(spark, lake, tmp_path):
    path, _, items = lake
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_slots_sizes_and_checksums(spark, lake):
    """What op5 tells of each row, and the draws by which a key descends the tree."""
    path, rows, _ = lake
    docs = spark.read.parquet(f"{path}/documents.parquet")
    got = sharding.assign(docs).collect()
    text = lambda r: (r[1] or "").encode()
    want = Counter((r[0], len(text(r)) + 8, zlib.crc32(text(r))) for r in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    by_shard = {}
    for r in got:
        by_shard.setdefault(r.shard, []).append(r.slot)
        assert r.law == "key" and r.grown_shard in (r.shard, 24)
    assert all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())
    shares = Counter(r.shard for r in sharding.assign(spark.range(24_000).selectExpr("id AS doc_id", "'x' AS text")).collect())
    assert len(shares) == 24 and all(abs(n - 1000) < 150 for n in shares.values())
