import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from swipelake.operators import balance, hashed_neighbours, neighbours
from swipelake.session import cut_lineage


def frame(spark, vectors, labels):
    rows = [(i, int(c), [float(x) for x in v]) for i, (v, c) in enumerate(zip(vectors, labels))]
    return spark.createDataFrame(rows, "id bigint, label int, vec array<double>")


def brute_force(df, k):
    """{pid: [(distance, near pid)]} over the distinct vectors of each class."""
    seen = {}
    for r in df.orderBy("id").collect():
        seen.setdefault((r["label"], tuple(r["vec"])), r["id"])
    out = {}
    for (label, v), pid in seen.items():
        others = [(float(np.linalg.norm(np.subtract(v, w))), q) for (c, w), q in seen.items() if c == label and q != pid]
        out[pid] = sorted(others)[:k]
    return out


def check(df, k, chunk_rows):
    points = cut_lineage(neighbours.distinct_points(df, "label", "id", "vec"))
    got = {}
    for r in neighbours.nearest_neighbours(points, k, cell_rows=chunk_rows, chunk_rows=chunk_rows).collect():
        got.setdefault(r["pid"], []).append((r["dist"], r["near_pid"]))
    want = {p: n for p, n in brute_force(df, k).items() if n}
    assert set(got) == set(want)
    for pid, near in want.items():
        mine = sorted(got[pid])
        assert [n for _, n in mine] == [n for _, n in near] or np.allclose(
            [d for d, _ in mine], [d for d, _ in near], rtol=1e-9, atol=1e-9
        )
        assert np.allclose([d for d, _ in mine], [d for d, _ in near], rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("chunk_rows", [2000, 40, 7])
def test_neighbours_equal_brute_force(spark, chunk_rows):
    rng = np.random.default_rng(chunk_rows)
    clusters = rng.normal(size=(6, 3)) * 20
    vectors = np.vstack([c + rng.normal(size=(35, 3)) for c in clusters])
    check(frame(spark, vectors, np.arange(len(vectors)) % 7 // 5), 5, chunk_rows)


@pytest.mark.parametrize("chunk_rows", [2000, 40])
def test_neighbours_are_the_same_from_parts_of_the_data(spark, monkeypatch, chunk_rows):
    monkeypatch.setattr(neighbours, "PART_ROWS", 60)
    rng = np.random.default_rng(5)
    check(frame(spark, rng.normal(size=(150, 3)), np.arange(150) % 7 // 5), 5, chunk_rows)


def test_far_cells_are_ruled_out():
    rng = np.random.default_rng(1)
    pivots = np.array([[0.0, 0.0], [10.0, 0.0], [100.0, 0.0]])
    members = [p + rng.normal(size=(50, 2)) * 2 for p in pivots]
    edges = [np.linalg.norm(m - p, axis=1) for m, p in zip(members, pivots)]
    cells = neighbours._Cells(pivots, np.array([e.min() for e in edges]), np.array([e.max() for e in edges]))
    reach = np.full(50, 3.0)
    rows, targets = neighbours.open_cells(members[0], np.zeros(50, dtype=int), reach, cells)
    assert 2 not in targets and 0 not in targets
    visited = set(zip(rows, targets))
    for i, q in enumerate(members[0]):
        for j in (1, 2):
            if np.linalg.norm(members[j] - q, axis=1).min() <= 3.0:
                assert (i, j) in visited


def test_a_point_visits_a_block_once(spark, monkeypatch):
    rng = np.random.default_rng(12)
    df = frame(spark, rng.normal(size=(600, 20)), np.zeros(600))  # nothing can be ruled out
    visits = []
    compare = neighbours._compare
    monkeypatch.setattr(neighbours, "_compare", lambda queries, *a, **b: visits.append(queries.count()) or compare(queries, *a, **b))
    check(df, 5, 5)
    assert len(visits) > 2 and sum(visits) <= 600 * neighbours.MIN_BLOCKS


def test_neighbours_in_row_blocks(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "_CELLS_AT_ONCE", 50)
    rng = np.random.default_rng(2)
    data = rng.normal(size=(40, 3))
    ids = np.arange(40)
    rows, cols, dist = neighbours.nearest_in_chunk(data, data, ids, ids, 4)
    full = np.linalg.norm(data[:, None] - data[None], axis=2)
    np.fill_diagonal(full, np.inf)
    assert (cols.reshape(40, 4) == full.argsort(1)[:, :4]).all() and (rows == np.repeat(ids, 4)).all()


def test_neighbours_with_many_equal_distances(spark):
    rng = np.random.default_rng(9)
    vectors = rng.integers(0, 4, size=(150, 3))
    check(frame(spark, vectors, np.zeros(150)), 5, 20)


def test_a_vector_that_is_a_third_of_all_rows(spark):
    rng = np.random.default_rng(5)
    vectors = np.vstack([np.zeros((60, 2)), rng.normal(size=(120, 2))])
    df = frame(spark, vectors, np.zeros(180))
    check(df, 5, 10)
    points = cut_lineage(neighbours.distinct_points(df, "label", "id", "vec"))
    assert points.count() == 121
    slots = balance.neighbour_slots(points, neighbours.nearest_neighbours(points, 5, cell_rows=10, chunk_rows=6), 5)
    of_copy = slots.where("pid = 0").first()["slots"]
    assert of_copy == [[0.0, 0.0]] * 5
    assert slots.where(F.size("slots") != 5).count() == 0


def test_classes_become_equal_and_points_lie_between_neighbours(spark):
    rng = np.random.default_rng(6)
    vectors = np.vstack([rng.normal(size=(70, 2)), rng.normal(size=(23, 2)) + 9, rng.normal(size=(8, 2)) - 9])
    labels = [0] * 70 + [1] * 23 + [2] * 8
    df = frame(spark, vectors, labels)
    made = balance.synthetic_points(df, "label", "id", "vec", cell_rows=10, chunk_rows=8).collect()
    assert {c: sum(r["label"] == c for r in made) for c in (0, 1, 2)} == {0: 0, 1: 47, 2: 62}
    near = brute_force(df, 5)
    per_base = {}
    for r in made:
        base, point = np.array(vectors[r["base_key"]]), np.array(r["vec"])
        per_base[r["base_key"]] = per_base.get(r["base_key"], 0) + 1
        gaps = []
        for _, q in near[r["base_key"]]:
            step = vectors[q] - base
            u = float((point - base) @ step / (step @ step))
            gaps.append(np.linalg.norm(base + u * step - point) if -1e-9 <= u <= 1 + 1e-9 else 1.0)
        assert min(gaps) < 1e-9
    assert max(per_base.values()) - min(v for b, v in per_base.items() if labels[b] == 1) <= 8
    again = balance.synthetic_points(df.repartition(3), "label", "id", "vec", cell_rows=30, chunk_rows=25).collect()
    assert sorted((r["base_key"], r["draw"], *r["vec"]) for r in made) == sorted(
        (r["base_key"], r["draw"], *r["vec"]) for r in again
    )


def test_small_classes(spark):
    df = frame(spark, [[0, 0], [1, 1], [5, 5], [5, 6], [7, 7], [8, 8], [9, 9]], [1, 1, 0, 0, 0, 0, 0])
    made = balance.synthetic_points(df, "label", "id", "vec").collect()
    assert len(made) == 3 and all(r["vec"][0] == r["vec"][1] and 0 <= r["vec"][0] <= 1 for r in made)
    single = frame(spark, [[3, 4], [1, 1], [2, 2]], [1, 0, 0])
    assert [r["vec"] for r in balance.synthetic_points(single, "label", "id", "vec").collect()] == [[3.0, 4.0]]


def test_copies_serve_as_bases_once_per_row(spark):
    vectors = [[0.0, 0.0]] * 6 + [[1.0, 0.0], [0.0, 1.0]] + [[5.0 + i, 5.0] for i in range(20)]
    df = frame(spark, vectors, [1] * 8 + [0] * 20)
    made = balance.synthetic_points(df, "label", "id", "vec").collect()
    counts = {p: sum(r["base_key"] == p for r in made) for p in (0, 6, 7)}
    assert sum(counts.values()) == 12
    assert 6 <= counts[0] <= 12 and 1 <= counts[6] <= 2 and 1 <= counts[7] <= 2


def test_steps_split_a_large_quota(spark, monkeypatch):
    monkeypatch.setattr(balance, "POINTS_PER_STEP", 7)
    df = frame(spark, [[0, 0], [1, 1]] + [[i, 5] for i in range(50)], [1] * 2 + [0] * 50)
    made = balance.synthetic_points(df, "label", "id", "vec").collect()
    assert len(made) == 48 and len({(r["base_key"], r["draw"]) for r in made}) == 48


def test_one_class_stays_as_it_is(spark):
    df = frame(spark, [[0, 0], [1, 1]], [1, 1])
    rows = balance.balance_classes(df, "label", "id", "vec").collect()
    assert len(rows) == 2 and not any(r["is_synthetic"] for r in rows)


def test_ml_vectors_are_kept(spark):
    df = frame(spark, [[0, 0], [1, 1], [5, 5], [6, 6], [7, 7]], [1, 1, 0, 0, 0])
    rows = balance.balance_classes(df.withColumn("vec", array_to_vector("vec")), "label", "id", "vec")
    assert rows.select(vector_to_array("vec")).count() == 6


def test_arrays_of_columns_that_are_never_null(spark):
    rows = spark.range(40).select(
        F.col("id"), (F.col("id") % 4 == 0).cast("int").alias("label"), F.array(F.col("id").cast("double"), F.lit(1.0)).alias("v")
    )
    sizes = {r["label"]: r["count"] for r in balance.balance_classes(rows, "label", "id", "v").groupBy("label").count().collect()}
    assert sizes == {0: 30, 1: 30}


@pytest.mark.parametrize("bad", [None, [1.0, None], [1.0, float("nan")]])
def test_unusable_vectors_fail_with_their_key(spark, bad):
    rows = spark.createDataFrame([(i, i % 3 == 0, [float(i), 0.5] if i != 27 else bad) for i in range(60)], "id long, label boolean, v array<double>")
    with pytest.raises(Exception, match="no usable vector at key 27"):
        balance.balance_classes(rows, "label", "id", "v").collect()


def test_vectors_of_different_lengths_fail(spark):
    rows = spark.createDataFrame([(i, i % 3 == 0, [1.0 * i] * (1 + (i == 27))) for i in range(60)], "id long, label boolean, v array<double>")
    with pytest.raises(ValueError, match="different lengths"):
        balance.balance_classes(rows, "label", "id", "v").collect()


def test_rounds_send_fewer_rows_than_all_open_cells(spark, monkeypatch):
    """Clustered points: the bounds of far cells are never reached. Without structure they mostly are."""
    sent = []
    compare = neighbours._compare

    def counted(queries, *more):
        sent.append(queries.count())
        return compare(queries, *more)

    monkeypatch.setattr(neighbours, "_compare", counted)
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(12, 4)) * 20
    shares = {}
    for name, spread, base in (("clustered", 0.5, centers), ("unstructured", 1.0, np.zeros((12, 4)))):
        data = [(1, i, (base[i % 12] + rng.normal(size=4) * spread).tolist(), 1) for i in range(600)]
        points = spark.createDataFrame(data, "grp int, pid long, vec array<double>, copies long").persist()
        sent.clear()
        found = neighbours.nearest_neighbours(points, 5, cell_rows=50).collect()
        x = np.array([d[2] for d in data])
        for pid in range(0, 600, 37):
            order = np.lexsort((np.arange(600), np.sqrt(((x - x[pid]) ** 2).sum(1))))
            want = [int(i) for i in order if i != pid][:5]
            got = sorted((r for r in found if r["pid"] == pid), key=lambda r: (r["dist"], r["near_pid"]))
            assert [r["near_pid"] for r in got] == want
        shares[name] = sum(sent[1:]) / 600  # cells visited per point besides its own
    assert shares["clustered"] < 3 < shares["unstructured"]


def sparse_rows(rng, n, places, each):
    """Rows with a few places, some of which most rows have."""
    out = np.zeros((n, places))
    for row in out:
        row[rng.choice(places, each, replace=False)] = rng.normal(size=each).round(2)
        row[:3] = rng.normal(size=3)
    return out


def pack(rows):
    return [np.r_[np.flatnonzero(r), r[np.flatnonzero(r)]] for r in rows]


@pytest.mark.parametrize("cells", [4_000_000, 97])
def test_sparse_products_and_distances(monkeypatch, cells):
    monkeypatch.setattr(neighbours, "_CELLS_AT_ONCE", cells)
    rng = np.random.default_rng(4)
    a, b = sparse_rows(rng, 60, 200, 9), sparse_rows(rng, 45, 200, 9)
    a[3] = b[7] = 0
    sa, sb = neighbours.Sparse.of(pack(a)), neighbours.Sparse.of(pack(b))
    assert np.allclose(sa.products(sb), a @ b.T) and np.allclose(sa.squares(), (a * a).sum(1))
    rows, cols = rng.integers(0, 60, 500), rng.integers(0, 45, 500)
    assert np.allclose(sa.apart(rows, sb, cols), ((a[rows] - b[cols]) ** 2).sum(1))
    part = np.array([5, 3, 3])
    assert np.allclose(sa[part].products(sb[10:20]), a[part] @ b[10:20].T)
    assert sa[np.array([3])].apart(np.array([0]), sb, np.array([7])).tolist() == [0.0]


@pytest.mark.parametrize("chunk_rows", [2000, 25])
def test_sparse_neighbours_equal_brute_force(spark, chunk_rows):
    rng = np.random.default_rng(chunk_rows)
    rows = sparse_rows(rng, 140, 300, 6)
    rows[50:60] = rows[0]
    df = frame(spark, rows, np.arange(140) % 3 // 2)
    packed_df = spark.createDataFrame([(i, int(np.arange(140)[i] % 3 // 2), [float(x) for x in p]) for i, p in enumerate(pack(rows))], df.schema)
    points = cut_lineage(neighbours.distinct_points(packed_df, "label", "id", "vec"))
    got = {}
    for r in neighbours.nearest_neighbours(points, 4, cell_rows=chunk_rows, chunk_rows=chunk_rows, sparse=True).collect():
        got.setdefault(r["pid"], []).append((r["dist"], r["near_pid"]))
    want = {p: n for p, n in brute_force(df, 4).items() if n}
    assert set(got) == set(want)
    for pid, near in want.items():
        assert np.allclose([d for d, _ in sorted(got[pid])], [d for d, _ in near], rtol=1e-9, atol=1e-9)


def test_sparse_vectors_give_the_same_points_as_dense_ones(spark):
    rng = np.random.default_rng(8)
    rows, labels = sparse_rows(rng, 60, 40, 5), np.r_[np.zeros(45), np.ones(15)]
    df = frame(spark, rows, labels)
    dense = balance.synthetic_points(df, "label", "id", "vec", 3)
    ml = df.withColumn("vec", array_to_vector("vec"))
    sparse = spark.createDataFrame([(r["id"], r["label"], Vectors.sparse(40, list(map(int, np.flatnonzero(r["vec"].toArray()))), [x for x in r["vec"].toArray() if x])) for r in ml.collect()], ml.schema)
    made = balance.synthetic_points(sparse.withColumn("vec", balance.packed(F.col("vec"))), "label", "id", "vec", 3, sparse=True)
    want = {(r["base_key"], r["draw"]): np.array(r["vec"]) for r in dense.collect()}
    got = {}
    for r in made.collect():
        got[r["base_key"], r["draw"]] = full = np.zeros(40)
        full[np.array(r["vec"][: len(r["vec"]) // 2], dtype=int)] = r["vec"][len(r["vec"]) // 2 :]
    assert want.keys() == got.keys() and all(np.allclose(want[k], got[k]) for k in want)
    for some in (ml, sparse):
        rows_out = balance.balance_classes(some, "label", "id", "vec", 3)
        assert rows_out.count() == 90 and rows_out.schema["vec"].dataType == ml.schema["vec"].dataType
        firsts = [r[0] for r in rows_out.where("is_synthetic").select(vector_to_array("vec")[0]).collect()]
        assert np.allclose(sorted(firsts), sorted(v[0] for v in want.values()))


def test_vectors_of_different_sizes_fail(spark):
    df = spark.createDataFrame([(1, 0, Vectors.sparse(3, [0], [1.0])), (2, 1, Vectors.sparse(4, [0], [1.0])), (3, 1, Vectors.sparse(4, [1], [1.0]))], ["id", "label", "vec"])
    with pytest.raises(ValueError, match="places"):
        balance.balance_classes(df, "label", "id", "vec")


def test_hashed_neighbours_of_clusters(spark):
    """Where neighbours are near, narrow steps find nearly all of them and compare few points."""
    rng = np.random.default_rng(6)
    centers = rng.normal(size=(40, 16)) * 30
    vectors = np.vstack([c + rng.normal(size=(25, 16)) * 0.3 for c in centers])
    vectors[:30] = vectors[0]
    df = frame(spark, vectors, np.zeros(len(vectors)))
    points = cut_lineage(neighbours.distinct_points(df, "label", "id", "vec"))
    exact = cut_lineage(neighbours.nearest_neighbours(points, 3))
    got = cut_lineage(hashed_neighbours.hashed_neighbours(points, 3, directions=4, spread=0.2))
    row = hashed_neighbours.recall(exact, got).first()
    assert row["neighbours"] == exact.count() and row["recall"] >= 0.95
    some = hashed_neighbours.hashed_neighbours(points, 3, "pid < 100", directions=4, spread=0.2, chunk_rows=7)
    assert sorted(map(str, some.collect())) == sorted(map(str, got.where("pid < 100").collect()))


def test_recall_by_hand(spark):
    exact = spark.createDataFrame([(0, 1, 2, 1, 0.5), (0, 1, 3, 1, 0.7), (0, 2, 1, 1, 0.5)], "grp int, pid long, near_pid long, near_copies long, dist double")
    row = hashed_neighbours.recall(exact, exact.where("near_pid = 2")).first()
    assert (row["neighbours"], round(row["recall"], 3)) == (3, 0.333)
