"""E8 decoding and embedding near-dedup against brute force."""

import itertools

import numpy as np

from equitylake.llm import lattice

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, least=0.95):
    good = {i: np.array(v, np.float64) for i, v in rows if i is not None and v is not None and None not in v
            and np.isfinite(v).all() and np.any(np.array(v) != 0)}
    links = {i: set() for i, _ in rows}
    for i, j in itertools.combinations(sorted(good), 2):
        a, b = good[i], good[j]
        if len(a) == len(b) and a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= least:
            links[i].add(j)
            links[j].add(i)
    low = {i: i for i in links}
    for _ in links:
        low = {i: min([low[i], *(low[j] for j in links[i])], key=lambda x: (x is None, x)) for i in links}
    return {i: (len(links[i]), low[i], low[i] == i) for i in links if i is not None}


def test_decoder_finds_the_nearest_lattice_point():
    rng = np.random.default_rng(1)
    assert len(lattice.ROOTS) == 240 and np.allclose((lattice.ROOTS**2).sum(1), 2)
    y = rng.normal(size=(500, 8)) * 3
    near = lattice.nearest_e8(y)
    assert np.all((near * 2) == np.rint(near * 2)) and np.all(near.sum(1) % 2 == 0)
    own = ((y - near) ** 2).sum(1)
    # No neighbour of the point found is nearer: it is the point whose cell holds y.
    others = ((y[:, None, :] - near[:, None, :] - lattice.ROOTS) ** 2).sum(2).min(1)
    assert (own <= others + 1e-9).all()


def vectors(dim=16):
    rng = np.random.default_rng(2)
    rows = []
    for c in range(12):
        centre = rng.normal(size=dim)
        rows += [centre + rng.normal(size=dim) * 0.12 for _ in range(12)]
    rows += [rng.normal(size=dim) for _ in range(60)]
    rows += [rows[0], rows[0] * 2, rows[0], -rows[0]]
    return [[float(np.float32(x)) for x in v] for v in rows]


def test_vectors_match_brute_force(spark):
    found = vectors()
    odd = [None, [], [0.0] * 16, [None] + [1.0] * 15, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15, [1.0, 2.0], [1.0, 2.001], found[3][:15]]
    rows = [(i * 3 + 1, v) for i, v in enumerate([*found, *odd])]
    df = spark.createDataFrame([(i, v, 0) for i, v in [*rows, rows[5], (None, found[0])]], SCHEMA).withColumnRenamed("label", "codes")
    got = lattice.near_duplicates(df).collect()
    want = brute(rows)
    assert len(got) == len(rows) + 2
    wrong = [r.vec_id for r in got if r.vec_id is not None and (r.n_links, r.component_id, r.kept) != want[r.vec_id]]
    assert not wrong
    assert [(r.n_links, r.component_id, r.kept) for r in got if r.vec_id is None] == [(0, None, True)]


def test_a_hot_cell_is_dealt_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(lattice, "BLOCK_ROWS", 8)
    rng = np.random.default_rng(5)
    centre = rng.normal(size=16)
    rows = [(i, [float(x) for x in np.float32(centre + rng.normal(size=16) * 0.02)]) for i in range(70)]
    got = lattice.near_duplicates(spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == brute(rows)


def test_finer_grids_match_brute_force_too(spark):
    found = vectors()
    rows = [(i, v) for i, v in enumerate(found)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    for _, grid in lattice.GRIDS[1:]:
        got = lattice.near_duplicates(df, grid=grid).collect()
        want = brute(rows)
        assert sum((r.n_links, r.component_id, r.kept) != want[r.vec_id] for r in got) <= 2
    assert lattice.grid_for(0) == lattice.grid_for(500_000) != lattice.grid_for(500_001)


def test_the_tables_size_does_not_choose_the_grid(spark, monkeypatch):
    """More rows, far from the others, leave the others' links as they are, on whichever side of a size they are."""
    none = lattice.Grid(1, 2, 0.01, 0)  # cells so small that only equal vectors meet
    monkeypatch.setattr(lattice, "GRIDS", ((20, lattice.GRIDS[0][1]), (1 << 62, none)))
    near = vectors()[:12]
    rng = np.random.default_rng(7)
    far = [[float(x) for x in -np.array(near[0]) + rng.normal(size=16) * 3] for _ in range(20)]
    few = lattice.near_duplicates(spark.createDataFrame([(i, v, 0) for i, v in enumerate(near)], SCHEMA)).collect()
    more = lattice.near_duplicates(spark.createDataFrame([(i, v, 0) for i, v in enumerate([*near, *far])], SCHEMA)).collect()
    assert sum(r.n_links for r in few) > 0
    assert sorted(few) == sorted(r for r in more if r.vec_id < len(near))


def test_empty_table(spark):
    assert lattice.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_an_id_at_several_vectors_names_no_class(spark):
    rng = np.random.default_rng(9)
    centres = [rng.normal(size=16) for _ in range(3)]
    # Places 0.. are vectors in three clusters; their ids repeat across clusters.
    places = [(c, [float(x) for x in np.float32(centres[c] + rng.normal(size=16) * 0.05)]) for c in (0, 0, 0, 1, 1, 1, 2)]
    ids = [5, 5, 6, 5, 7, 8, 5]
    got = lattice.near_duplicates(spark.createDataFrame([(i, v, 0) for i, (_, v) in zip(ids, places)], SCHEMA)).collect()
    want = brute([(n, v) for n, (_, v) in enumerate(places)])  # by place, each a vector of its own
    rows = []
    for n, i in enumerate(ids):
        cluster = [m for m in range(len(ids)) if want[m][1] == want[n][1]]
        component = min(ids[m] for m in cluster)
        rows.append((i, want[n][0], component, i == component))
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in got) == sorted(rows)


def test_recall_at_the_threshold():
    """Pairs of cosine 0.95 to 0.96 that share a cell in some table, at two sizes of vector, by every grid."""
    for dim, (_, grid) in itertools.product((16, 128), lattice.GRIDS):
        rng = np.random.default_rng(dim)
        a = rng.normal(size=(3000, dim))
        a /= np.linalg.norm(a, axis=1, keepdims=True)
        side = rng.normal(size=a.shape)
        side -= (side * a).sum(1, keepdims=True) * a
        side /= np.linalg.norm(side, axis=1, keepdims=True)
        cos = rng.uniform(0.95, 0.96, size=(len(a), 1))
        x, y = lattice.cell_codes(a, grid), lattice.cell_codes(a * cos + side * np.sqrt(1 - cos**2), grid)
        met = (x[:, :, :, None] == y[:, :, None, :]).any((1, 2, 3))
        assert met.mean() >= 0.99
