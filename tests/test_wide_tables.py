"""Correlation and selection on tables of many columns."""

import random
import subprocess
import sys
from pathlib import Path

import numpy as np
import pandas as pd
import pytest

from tabloom.operators import correlation, select

ROOT = Path(__file__).resolve().parent.parent


@pytest.mark.parametrize("tile", [1, 3, 5, 1024])
def test_tiles_change_nothing(spark, monkeypatch, tile):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 7)) @ rng.normal(size=(7, 7))
    x[rng.random(x.shape) < 0.1] = np.nan
    x[:, 3], x[:, 4] = 2.0, np.nan
    table = pd.DataFrame(x, columns=list("abcdefg"))
    monkeypatch.setattr(correlation, "TILE", tile)
    monkeypatch.setattr(correlation, "ROW_BYTES", 2000)
    rows = correlation.correlation_table(spark.createDataFrame(table).repartition(3), list(table)).collect()
    want = table.corr()
    assert [(r["left"], r["right"]) for r in rows] == [(a, b) for i, a in enumerate(table) for b in list(table)[i + 1 :]]
    for r in rows:
        expected = want.loc[r["left"], r["right"]]
        assert r["pairs"] == (table[r["left"]].notna() & table[r["right"]].notna()).sum()
        assert r["correlation"] is None if np.isnan(expected) else r["correlation"] == pytest.approx(expected, abs=1e-9)


def test_wide_tiles_stay_small():
    """A task on 3,000 columns with gaps holds less than a gigabyte."""
    code = """
import resource
import numpy as np, pyarrow as pa
from tabloom.functions.wide import chunks
from tabloom.operators import correlation
rng = np.random.default_rng(0)
tiles = chunks(list(range(3000)), correlation.TILE)
count = 0
for a, left in enumerate(tiles):
    for right in tiles[a:]:
        names = list(dict.fromkeys([*left, *right]))
        def batches():
            for _ in range(2):
                x = rng.normal(size=(3000, len(names)))
                x[rng.random(x.shape) < 0.01] = np.nan
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in x.T], names=[f"v{i}" for i in names])
        count += sum(1 for _ in correlation._tile_sums(left, right)(batches()))
print(count, resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=ROOT, check=True, timeout=600)
    count, megabytes = map(int, out.stdout.split())
    assert count == 1024 * 3 + 1024 * 2 + 952 and megabytes < 1024


def in_order(edges):
    lost = set()
    for i, j, loser in sorted(edges):
        if i not in lost and j not in lost:
            lost.add(loser)
    return lost


@pytest.mark.parametrize("seed", range(4))
def test_rounds_equal_the_ordered_scan(spark, seed):
    draw = random.Random(seed)
    nodes = 14
    pairs = {tuple(sorted(draw.sample(range(nodes), 2))) for _ in range(draw.choice([12, 30, 80]))}
    edges = [(i, j, draw.choice([i, j])) for i, j in pairs]
    df = spark.createDataFrame(edges, "i int, j int, loser int")
    assert select.ordered_losers(df, max_pairs=0) == in_order(edges) == select.ordered_losers(df)


def test_many_equal_columns_are_one_round(spark, monkeypatch):
    """Two thousand equal columns: two million pairs, of which the driver sees names only."""
    edges = spark.range(2000).selectExpr("cast(id as int) as i").join(spark.range(2000).selectExpr("cast(id as int) as j"))
    edges = edges.where("i < j").selectExpr("i", "j", "j as loser")
    rounds = []
    materialize = select.materialize
    monkeypatch.setattr(select, "materialize", lambda df, label: rounds.append(label) or materialize(df, label))
    assert select.ordered_losers(edges) == set(range(1, 2000))
    assert len(rounds) == 2
