"""SimHash groups against comparing every pair of fingerprints."""

import random

import xxhash
from pyspark.sql import types as T

from sediment.llm import common, simhash

SCHEMA = "doc_id long, text string, _id string, _hash string, fp string, root string"


def brute_fingerprint(text, k=3):
    words, word = [], ""
    for c in (text or "") + " ":
        if c in " \t\n\x0b\x0c\r":
            words += [word] if word else []
            word = ""
        else:
            word += chr(ord(c) + 32) if "A" <= c <= "Z" else c
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids_and_fps, bits):
    root = list(range(len(ids_and_fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (_, a) in enumerate(ids_and_fps):
        for j, (_, b) in enumerate(ids_and_fps[:i]):
            if bin(a ^ b).count("1") <= bits:
                root[find(i)] = find(j)
    smallest = {}
    for i, (name, _) in enumerate(ids_and_fps):
        known = smallest.get(find(i))
        smallest[find(i)] = name if known is None or (name is not None and name < known) else known
    return [smallest[find(i)] for i in range(len(ids_and_fps))]


def signed(fp):
    return fp - (1 << 64) if fp >> 63 else fp


def test_fingerprint_equals_bit_by_bit_count():
    texts = [None, "", " \t\n", "One", "one TWO", "a b c d a b c d", "Éa éA x" * 40, "word " * 70_000]
    for text in texts:
        assert simhash.fingerprint(text.encode() if text is not None else None) == signed(brute_fingerprint(text))


def documents():
    draw = random.Random(5)
    words = [f"w{i}" for i in range(200)]
    base = [" ".join(draw.choices(words, k=60)) for _ in range(20)]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(100 + i, t + " tail") for i, t in enumerate(base[:10])]
    rows += [(200, base[0]), (200, base[0]), (None, base[1]), (201, None), (202, ""), (203, "   "), (None, "only"), (None, "only")]
    return [(i, t, "clash", "clash", "clash", "clash") for i, t in rows]


def test_groups_equal_all_pairs(spark):
    rows = documents()
    got = simhash.groups(spark.createDataFrame(rows, SCHEMA)).collect()
    fps = [(r[0], brute_fingerprint(r[1])) for r in rows]
    wanted = sorted(((r[0], signed(f[1]), c) for r, f, c in zip(rows, fps, brute_components(fps, 2), strict=True)), key=str)
    assert sorted(((r["_id"], r["fp"], r["component_id"]) for r in got), key=str) == wanted


def test_crowded_cells_lose_no_link(spark):
    draw = random.Random(7)
    centre = draw.getrandbits(64)
    fps = {centre}
    while len(fps) < 400:  # a dense cloud, chains through it, and strangers
        fp = draw.choice(sorted(fps))
        for _ in range(draw.choice((1, 2, 2, 3))):
            fp ^= 1 << draw.randrange(64)
        fps.add(fp)
    fps |= {draw.getrandbits(64) for _ in range(100)}
    rows = [(signed(f),) for f in sorted(fps)]
    wanted = brute_components([(signed(f), f) for f in sorted(fps)], 2)
    for crowded in (0, 3, 10_000):
        links = simhash.near_pairs(spark.createDataFrame(rows, "fp long"), 2, crowded=crowded)
        pairs = [(r["a"], r["b"]) for r in links.collect()]
        assert all(bin((a ^ b) & (1 << 64) - 1).count("1") <= 2 for a, b in pairs)
        found = dict(simhash.components(links).collect())
        assert [found.get(r[0], r[0]) for r in rows] == wanted


def test_nothing_exploded_is_broadcast(spark, tmp_path, monkeypatch):
    """A file of fingerprints under the broadcast limit still makes many times its size in cells."""
    draw = random.Random(9)
    fps = {draw.getrandbits(64) for _ in range(300)}
    fps |= {f ^ 1 << draw.randrange(64) for f in sorted(fps)[:100]}
    spark.createDataFrame([(signed(f),) for f in sorted(fps)], "fp long").write.parquet(f"{tmp_path}/fps")
    plans, written = [], common.materialise

    def noted(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return written(df, label)

    monkeypatch.setattr(simhash, "materialise", noted)
    monkeypatch.setattr(common, "materialise", noted)
    roots = simhash.components(simhash.near_pairs(spark.read.parquet(f"{tmp_path}/fps"), crowded=1))
    assert roots.select("root").distinct().count() == 100
    assert len(plans) >= 3 and all("SortMergeJoin" in p for p in plans)
    assert not [p for p in plans if "Broadcast" in p]


def test_one_of_each_group_stays(spark):
    frame = spark.createDataFrame(documents(), SCHEMA)
    kept = simhash.keep_one(frame)
    assert kept.columns == frame.columns
    rows = kept.collect()
    groups = simhash.groups(frame).select("root", "component_id").distinct().collect()
    assert len(rows) == len(groups)
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(g["component_id"]) for g in groups)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash.groups(empty).collect() == []
    assert simhash.keep_one(empty).collect() == []
    assert isinstance(simhash.keep_one(empty).schema["doc_id"].dataType, T.LongType)
