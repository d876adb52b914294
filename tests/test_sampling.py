import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerlens.functions.numeric import hash32
from ledgerlens.operators import neighbours, sampling
from ledgerlens.operators.neighbours import approximate_neighbours, nearest_neighbours, neighbour_recall


def _points(spark, n, kind):
    """``n`` points in 6 dimensions; kinds with copies and with a dense clump."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(n, 6)) * np.array([1, 1, 5, 0.1, 20, 1])
    if kind == "copies":
        x[: n // 3] = x[0]
        x[n // 3 : n // 3 + 4] = x[n // 3]
    if kind == "clump":
        x[: n // 3] = x[0] + rng.normal(size=(n // 3, 6)) * 1e-6
    if kind == "lattice":
        x = np.floor(x)
    if kind == "far":
        x = x + 1e6
    ids = rng.permutation(n) * 3 + 1
    rows = [(int(i), [float(v) for v in p]) for i, p in zip(ids, x)]
    return spark.createDataFrame(rows, "id bigint, x array<double>").repartition(4), ids, x


def _brute(ids, x, k):
    out = {}
    for i, p in zip(ids, x):
        d2 = np.zeros(len(x))
        for j in range(x.shape[1]):
            d2 += (p[j] - x[:, j]) ** 2
        ranked = sorted((d, int(o)) for d, o in zip(d2, ids) if o != i)[:k]
        out[int(i)] = [o for _, o in ranked]
    return out


@pytest.mark.parametrize("kind", ["plain", "copies", "clump", "lattice", "far"])
@pytest.mark.parametrize("options", [{}, {"cell_rows": 25, "query_chunk": 16, "member_chunk": 20}])
def test_neighbours_equal_brute_force(spark, kind, options):
    points, ids, x = _points(spark, 420, kind)
    got = {}
    for r in nearest_neighbours(points, 5, **options).orderBy("id", "rank").collect():
        got.setdefault(r.id, []).append(r.neighbour_id)
    assert got == _brute(ids, x, 5)


def test_many_cells_with_few_rows(spark):
    points, ids, x = _points(spark, 60, "plain")
    rows = nearest_neighbours(points, 5, cell_rows=1).collect()
    want = _brute(ids, x, 5)
    assert {(r.id, r.rank, r.neighbour_id) for r in rows} == {
        (i, n + 1, o) for i, near in want.items() for n, o in enumerate(near)
    }


def test_too_few_rows(spark):
    points, _, _ = _points(spark, 5, "plain")
    with pytest.raises(ValueError, match="at least 6 rows"):
        nearest_neighbours(points, 5)


def test_apportion_by_largest_remainder():
    assert sampling.apportion({0: 940, 1: 60}, 0.2) == {0: 188, 1: 12}
    assert sampling.apportion({0: 7, 1: 4}, 0.2) == {0: 2, 1: 1}
    assert sum(sampling.apportion({0: 333, 1: 334, 2: 335}, 0.2).values()) == 201


@pytest.fixture(scope="module")
def labelled(spark):
    table = spark.range(1200).select("id", (F.col("id") % 12 == 0).cast("int").alias("class"))
    u = [hash32(f"u{i}", F.col("id")) / 2.0**32 for i in range(3)]
    return table.select(
        "id",
        "class",
        # A third of the minority rows are copies of one row.
        *[F.when((F.col("class") == 1) & (F.col("id") % 36 == 0), 0.5).otherwise(c).alias(f"f{i}") for i, c in enumerate(u)],
        F.when(F.col("id") % 36 == 0, 7).otherwise((u[0] * 24).cast("int")).alias("hour"),
    )


FEATURES = ["f0", "f1", "f2", "hour"]


def test_split_is_exact_and_stable(labelled):
    parted = sampling.stratified_split(labelled)
    counts = {(r["split"], r["class"]): r["count"] for r in parted.groupBy("split", "class").count().collect()}
    assert counts == {("test", 0): 220, ("test", 1): 20, ("train", 0): 880, ("train", 1): 80}
    again = sampling.stratified_split(labelled.repartition(7))
    assert parted.select("id", "split").exceptAll(again.select("id", "split")).count() == 0
    other = sampling.stratified_split(labelled, seed=7).select("id", "split")
    assert parted.select("id", "split").exceptAll(other).count() > 0


def test_threshold_split_is_close(labelled):
    share = sampling.stratified_split(labelled, exact=False).where("split = 'test'").count() / 1200
    assert 0.15 < share < 0.25


def test_folds_are_even(labelled):
    counts = sampling.stratified_kfold(labelled, k=7).groupBy("class", "fold").count().collect()
    for label in (0, 1):
        sizes = [r["count"] for r in counts if r["class"] == label]
        assert len(sizes) == 7 and max(sizes) - min(sizes) <= 1


def test_smote_balances_and_interpolates(labelled):
    table = sampling.smote(labelled, FEATURES)
    totals = {r["class"]: r["count"] for r in table.groupBy("class").count().collect()}
    assert totals == {0: 1100, 1: 1100}
    assert table.where("not is_synthetic").count() == 1200
    per_base = [r["count"] for r in table.where("is_synthetic").groupBy("id").count().collect()]
    assert len(per_base) == 100 and max(per_base) - min(per_base) <= 1
    assert table.where("is_synthetic").select("id", "copy_no").distinct().count() == 1000
    rows = {r.id: r for r in labelled.where("class = 1").collect()}
    near = {}
    for r in sampling.smote_knn(labelled, FEATURES).collect():
        near.setdefault(r.id, []).append(rows[r.neighbour_id])
    for r in table.where("is_synthetic").collect():
        base, ok = rows[r.id], False
        for other in near[r.id]:
            gaps = [other[f] - base[f] for f in FEATURES[:3]]
            widest = max(range(3), key=lambda i: abs(gaps[i]))
            u = 0.0 if gaps[widest] == 0 else (r[FEATURES[widest]] - base[FEATURES[widest]]) / gaps[widest]
            on_line = all(abs(base[f] + u * g - r[f]) < 1e-9 for f, g in zip(FEATURES, gaps))
            hour = int(base.hour + u * (other.hour - base.hour) + 1e-9), int(base.hour + u * (other.hour - base.hour))
            ok = ok or (on_line and -1e-9 <= u < 1 and r.hour in hour)
        assert ok


def test_smote_ratio_and_nothing_to_do(labelled):
    half = sampling.smote(labelled, FEATURES, ratio=0.5)
    assert half.where("class = 1").count() == 550
    same = sampling.smote(labelled, FEATURES, ratio=0.05)
    assert same.where("is_synthetic").count() == 0 and same.count() == 1200


def test_only_train_rows_are_synthetic(labelled):
    splits = sampling.resampled_splits(labelled, FEATURES)
    assert splits.where("split = 'test' and is_synthetic").count() == 0
    assert splits.where("split = 'test'").count() == 240
    balance = {(r.stage, r.split, r["class"]): r.n for r in sampling.class_balance_report(splits).collect()}
    assert balance[("before", "train", 1)] == 80 and balance[("after", "train", 1)] == 880
    assert balance[("before", "test", 1)] == balance[("after", "test", 1)] == 20
    sides = splits.where("not is_synthetic").groupBy("id").agg(F.countDistinct("split").alias("n"))
    assert sides.where("n <> 1").count() == 0 and sides.count() == 1200


def _clustered(spark, n):
    rng = np.random.default_rng(n)
    centres = np.random.default_rng(1).normal(size=(60, 8)) * 4
    x = centres[rng.integers(0, 60, n)] + rng.normal(size=(n, 8)) * 0.4
    return spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "id bigint, x array<double>"), x


def test_share_of_measured_pairs_falls_with_size(spark):
    shares = []
    for n in (1_000, 4_000, 16_000):
        points, _ = _clustered(spark, n)
        pairs = []
        assert nearest_neighbours(points.repartition(8), 5, pairs=pairs).count() == 5 * n
        shares.append(sum(pairs) / n**2)
    assert shares[0] > 1.5 * shares[1] > 2 * shares[2]


def test_hashed_neighbours_find_nearly_all(spark):
    points, _ = _clustered(spark, 2_000)
    exact, found = nearest_neighbours(points, 5), approximate_neighbours(points, 5, query_chunk=500, member_chunk=700)
    told = neighbour_recall(exact, found).first()
    assert told.wanted == 10_000 and told.recall >= 0.9
    rows = {(r.id, r.neighbour_id): r.distance for r in found.collect()}
    same = {(r.id, r.neighbour_id): r.distance for r in exact.collect()}
    assert all(rows[k] == pytest.approx(d) for k, d in same.items() if k in rows)


def test_neighbour_tables_in_a_task_are_bounded(monkeypatch):
    """With more pivots or members a task looks at fewer rows at once, and finds the same."""
    rng = np.random.default_rng(3)
    pivots, x = rng.normal(size=(300, 4)), rng.normal(size=(200, 4))
    home = neighbours._home_kernel(pivots)(pd.Series(list(x)))
    rows = pd.DataFrame({"id": range(200), "x": list(x), "cell": home["cell"], "reach": np.full(200, 1.5)})
    members = pd.DataFrame({"member_id": range(100, 400), "member_x": list(rng.normal(size=(300, 4)))})

    def found():
        tables = list(neighbours._visit_kernel(pivots, np.full(300, 0.5), 3, None)(iter([rows])))
        visits = {i: list(v) for t in tables for i, v in zip(t["id"], t["visit"])}
        return max(map(len, tables)), visits, neighbours._search_kernel(5)(rows[["id", "x"]], members)

    most, visits, near = found()
    monkeypatch.setattr(neighbours, "BATCH_CELLS", 3000)
    few, same_visits, same_near = found()
    assert most > 100 and few <= 10
    assert visits == same_visits and near.equals(same_near)


def test_far_cells_are_neither_measured_nor_sorted(monkeypatch):
    """Work of a row follows the cells in its reach, and the visits are those of ordering all cells."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 6)) * 100
    pivots = centres[rng.integers(0, 40, 2000)] + rng.normal(size=(2000, 6))
    x = pivots[rng.integers(0, 2000, 150)] + rng.normal(size=(150, 6)) * 0.1
    home = neighbours._home_kernel(pivots)(pd.Series(list(x)))
    rows = pd.DataFrame({"id": range(150), "x": list(x), "cell": home["cell"], "reach": np.full(150, 1.0)})
    radius = np.full(2000, 0.5)
    gaps = np.sqrt(((x[:, None] - pivots[None]) ** 2).sum(axis=2))
    between = np.sqrt(((pivots[home["cell"]][:, None] - pivots[None]) ** 2).sum(axis=2))
    own = np.take_along_axis(gaps, home["cell"].to_numpy()[:, None], axis=1)
    plane = np.divide(gaps**2 - own**2, 2 * between, out=np.zeros_like(gaps), where=between > 0)
    least = np.maximum(np.maximum(gaps - 0.5, plane), 0.0)
    least[np.arange(150), home["cell"]] = -1.0
    sizes = []
    for name in ("argsort", "lexsort"):
        plain = getattr(np, name)
        monkeypatch.setattr(np, name, lambda a, *o, plain=plain, **kw: sizes.append(np.size(a)) or plain(a, *o, **kw))
    seen = [{}, {}]
    for found, (begin, end) in zip(seen, ((0, 3), (3, None))):
        for t in neighbours._visit_kernel(pivots, radius, begin, end)(iter([rows])):
            found.update({i: list(v) for i, v in zip(t["id"], t["visit"])})
    assert sum(sizes) < 150 * 2000
    monkeypatch.undo()
    for i in range(150):
        near = [c for c in np.argsort(least[i], kind="stable")[1:] if least[i, c] <= 1.0]
        assert set(seen[0].get(i, []) + seen[1].get(i, [])) == set(near)
        assert len(seen[0].get(i, [])) == min(3, len(near))
        assert sorted(least[i, seen[0].get(i, [])]) == pytest.approx(sorted(least[i, near[:3]]), abs=1e-3)


def test_hash_tables_in_turns_find_the_same(spark, monkeypatch):
    """Rows sent for one table at a time; tables of earlier turns and rounds are deleted."""
    from ledgerlens import session

    points, _ = _clustered(spark, 500)
    told = lambda: sorted(tuple(r) for r in approximate_neighbours(points, 5, tables=4).collect())
    whole = told()
    monkeypatch.setattr(neighbours, "SENT_BYTES", 1)
    before = len(session._scratch_paths)
    assert told() == whole
    kept = [p.split("ledgerlens-")[1].split("-")[0] for p in session._scratch_paths[before:]]
    assert kept.count("near") == 1 and "hashed" not in kept
    before = len(session._scratch_paths)
    nearest_neighbours(points, 5, cell_rows=8)
    kept = [p.split("ledgerlens-")[1].split("-")[0] for p in session._scratch_paths[before:]]
    assert sorted(kept) == ["members", "near"]
