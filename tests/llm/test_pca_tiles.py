"""Linked vectors against all cosines."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sediment.llm import pca_tiles

SCHEMA = "vec_id long, embedding array<float>, label int, vector string, node string, root string"


def brute(rows, threshold=0.95):
    good = {}
    for k, (_, v) in enumerate(rows):
        if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array([np.float32(c) for c in v], dtype=np.float64)
            x = x / np.abs(x).max()
            good[k] = x / np.linalg.norm(x)
    near = {k: [j for j in good if j != k and len(good[j]) == len(good[k]) and good[j] @ good[k] >= threshold] for k in good}
    out = []
    for k, (vec_id, _) in enumerate(rows):
        reach, todo = {k}, [k]
        while todo:
            for j in near.get(todo.pop(), []):
                if j not in reach:
                    reach.add(j)
                    todo.append(j)
        component = min((rows[j][0] for j in reach if rows[j][0] is not None), default=None)
        out.append((vec_id, len(near.get(k, [])), component, vec_id == component))
    return sorted(out, key=str)


def vectors():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 24))
    rows = [(i, (centres[i % 12] + rng.normal(size=24) * (0.05 if i % 3 else 0.4)).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(40)]
    rows += [(2000, None), (2001, []), (2002, [0.0] * 24), (2003, [1.0, None] * 12), (2004, [float("nan")] * 24), (2005, [float("inf")] + [1.0] * 23)]
    rows += [(None, rows[1][1]), (None, [0.0] * 23 + [1.0]), (7, rows[7][1]), (2006, [1.0, 2.0]), (2007, [2.0, 4.0]), (2008, [1e-30] * 24), (2009, [3e30] * 24)]
    return rows


@pytest.mark.parametrize("tile", [2048, 16])
def test_matches_all_cosines(spark, monkeypatch, tile):
    monkeypatch.setattr(pca_tiles, "TILE", tile)
    rows = vectors()
    frame = spark.createDataFrame([(*r, 0, "v", "n", "r") for r in rows], SCHEMA)
    got = pca_tiles.neighbours(frame)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)


def test_empty_and_unsound(spark):
    frame = spark.createDataFrame([(*r, 0, "v", "n", "r") for r in vectors()], SCHEMA)
    assert pca_tiles.neighbours(frame.limit(0)).collect() == []
    assert pca_tiles.neighbours(frame.where("vec_id in (2000, 2002)")).count() == 2


def test_bounds_give_up_no_link():
    rng = np.random.default_rng(5)
    base = rng.normal(size=(1, 64))
    a, b = base + rng.normal(size=(90, 64)) * 0.35, base + rng.normal(size=(70, 64)) * 0.35
    basis = pca_tiles.axes(np.concatenate((a, b)))
    i, j = pca_tiles.linked(a, b, basis, 0.9)
    wanted = np.nonzero(pca_tiles.unit(a) @ pca_tiles.unit(b).T >= 0.9)
    assert sorted(zip(i, j, strict=True)) == sorted(zip(*wanted, strict=True)) and len(i)


def test_vectors_do_not_travel_with_pairs(spark, monkeypatch):
    """Whatever the number of pairs of tiles, only their names are dealt out."""
    monkeypatch.setattr(pca_tiles, "TILE", 16)
    plans, written = {}, pca_tiles.materialise

    def noted(df, label):
        plans[label] = df._jdf.queryExecution().executedPlan().toString(), df.columns
        return written(df, label)

    monkeypatch.setattr(pca_tiles, "materialise", noted)
    rng = np.random.default_rng(13)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(400)]
    frame = spark.createDataFrame([(*r, 0, "v", "n", "r") for r in rows], SCHEMA)
    got = pca_tiles.neighbours(frame)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)
    compared, columns = plans["vector-links"]
    assert columns == ["node", "links", "root"] and "name2" in compared
    assert "vectors" not in compared and "embedding" not in compared
    assert not {"embedding", "vector", "vectors"} & set(plans["tile-pairs"][1])


def test_one_key_for_all_vectors_mixes_none_up(spark, monkeypatch):
    monkeypatch.setattr(pca_tiles, "key", lambda vector: F.lit(1).cast("long"))
    rows = vectors()
    frame = spark.createDataFrame([(*r, 0, "v", "n", "r") for r in rows], SCHEMA)
    assert sorted((tuple(r) for r in pca_tiles.neighbours(frame).collect()), key=str) == brute(rows)


@pytest.mark.parametrize("kind", ["float", "double"])
def test_small_blocks_squares_and_sums(spark, monkeypatch, kind):
    """Dense groups over many tiles, results summed up often, hardly a tile at hand; zeros of either sign are equal."""
    for name, value in (("TILE", 8), ("BLOCK", 3), ("STEPS", (2, 5)), ("GATHERED", 4), ("AT_HAND", 1)):
        monkeypatch.setattr(pca_tiles, name, value)
    rng = np.random.default_rng(17)
    rows = [(i, (np.ones(9) + rng.normal(size=9) * (0.02 if i % 4 else 0.5)).tolist()) for i in range(150)]
    rows += [(500, [0.0] * 8 + [1.0]), (501, [-0.0] * 8 + [1.0]), (502, [1.0] + [0.0] * 8)]
    got = pca_tiles.neighbours(spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>"))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)


def test_rounding_decides_no_link():
    """Single precision only passes over what is far from the threshold: cosines next to it are told apart."""
    rng = np.random.default_rng(19)
    base, away = pca_tiles.unit(rng.normal(size=(1, 40)))[0], rng.normal(size=40)
    away -= (away @ base) * base
    away /= np.linalg.norm(away)
    cosines = 0.9 + np.arange(-20, 20) * 1e-9
    b = cosines[:, None] * base + np.sqrt(1 - cosines**2)[:, None] * away
    basis = pca_tiles.axes(rng.normal(size=(100, 40)))
    assert pca_tiles.linked(base[None], b, basis, 0.9)[1].tolist() == np.flatnonzero(pca_tiles.unit(b) @ base >= 0.9).tolist()


def test_results_of_a_task_are_summed_up():
    node, links, root = (np.array(x) for x in ([5, 3, 9, 5, 7], [1, 1, 2, 4, 1], [3, 3, 9, 9, 7]))
    every, total, low = pca_tiles.joined(node, links, root)
    assert every.tolist() == [3, 5, 7, 9] and total.tolist() == [1, 5, 1, 2] and low.tolist() == [3, 3, 7, 3]
