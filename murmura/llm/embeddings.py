"""Near-duplicate vectors: tiles in the order of principal components, compared dimension by dimension.

The second moments of all unit vectors are summed by partition; their eigenvectors rotate the
vectors so that leading dimensions carry most of every product. Cuts along the leading dimensions, taken
from a bounded sample, deal the vectors into tiles, whose boxes (over all vectors) bound the distance to
other tiles: a vector goes to a pair of tiles only if the other box is near enough for a cosine of
0.9. Within a pair, products add up over the leading dimensions first; the norms of the remaining ones
bound what can still come, and a block whose cosines cannot reach the threshold stops there. The
cosine that decides is the product of the given components in double precision.

How far the products go before they are first held against the bound depends on the data: to the dimension
where half of all squared length is behind. Bounds are kept in single precision, with a margin above its
rounding; vectors without preferred directions let no tile be skipped, and then all pairs of tiles are compared.

Vectors of each length are compared among themselves. Equal vectors are one class from the start, with a number of its own. A pair of tiles returns, for each vector with links there, how
many it has and one representative of those it is connected to, so a group of n linked vectors
costs n rows a pair, not n squared.

Bounds: SAMPLE vectors choose the cuts, at most LEAVES boxes travel to the tasks, and a leaf of more than
TILE vectors is split by hash. All vectors are compared whatever these are.

Cases: a vector that is null, empty, zero, or has null or non-finite components links with nothing, and so
do vectors of different lengths. Rows that repeat a vec_id are separate vectors of that id, linked and grouped
by what each of them holds; a row without vec_id has no component, no links and is kept. No rows give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmura.llm.common import components, lowest, settle, slices, summed

LEAST = 0.9
SAMPLE, LEAVES, TILE, BLOCK = 20_000, 4096, 8192, 1024
LEAD = 8  # dimensions that boxes and the first products use
_SLACK = 1e-9
#: Shares of the squared length after which products are held against the threshold.
STOPS = (0.5, 0.75)


def _usable(vectors: DataFrame) -> DataFrame:
    """vec_id, its vector packed (double), digest and length; the last three null if unusable."""

    def pack(batches):
        for batch in batches:
            packed, digest, length = [], [], []
            for x in batch.column("embedding"):
                v = None
                if x.is_valid and len(x) and not x.values.null_count:
                    v = x.values.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0
                    scale = np.abs(v).max()
                    if not np.isfinite(scale) or scale == 0:
                        v = None
                packed.append(None if v is None else v.tobytes())
                digest.append(None if v is None else xxhash.xxh128_digest(v.tobytes()))
                length.append(None if v is None else len(v))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(packed, pa.binary()), pa.array(digest, pa.binary()), pa.array(length, pa.int32())],
                ["vec_id", "packed", "digest", "length"],
            )

    return vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).mapInArrow(
        pack, "vec_id long, packed binary, digest binary, length int"
    )


def _matrix(column) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows)).reshape(len(rows), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _cuts(sample: np.ndarray, leaves: int) -> list[tuple[int, float]]:
    """Medians of a binary tree of splits in heap order: (dimension, value) of each inner node."""
    nodes: list[tuple[int, float]] = []
    level = [sample]
    while 2 * len(level) <= leaves:
        below = []
        for part in level:
            if len(part):
                at = int(np.argmax(part.var(axis=0)))
                value = float(np.median(part[:, at]))
            else:
                at, value = 0, 0.0
            nodes.append((at, value))
            below += [part[part[:, at] < value], part[part[:, at] >= value]]
        level = below
    return nodes


def _leaf(lead: np.ndarray, nodes: list[tuple[int, float]]) -> np.ndarray:
    at = np.zeros(len(lead), np.int64)
    depth = (len(nodes) + 1).bit_length() - 1
    dims, values = (np.array(x) for x in zip(*nodes)) if nodes else (np.zeros(0, int), np.zeros(0))
    for _ in range(depth):
        at = 2 * at + 1 + (lead[np.arange(len(lead)), dims[at]] >= values[at])
    return at - len(nodes)


def _margin(length: int) -> float:
    """More than single precision can be off in a product of two unit vectors."""
    return _SLACK + 2 * (length + 4) * float(np.finfo(np.float32).eps)


def _links_of_block(a: np.ndarray, b: np.ndarray, tails_a: np.ndarray, tails_b: np.ndarray, steps: list[int], least: float):
    """Rows and columns of a block with a cosine that may reach ``least``, and the cosines there."""
    rows, cols = np.arange(len(a)), np.arange(len(b))
    least, product, done = np.float32(least - _margin(a.shape[1])), None, 0
    for k, upto in enumerate(steps):
        part = a[rows, done:upto] @ b[cols, done:upto].T
        product, done = part if product is None else product + part, upto
        if upto == a.shape[1]:
            break
        may = product >= least - tails_a[rows, k][:, None] * tails_b[cols, k][None, :]
        r, c = may.any(axis=1), may.any(axis=0)
        if not r.any():
            return rows[:0], cols[:0], product[:0, :0]
        rows, cols, product = rows[r], cols[c], product[r][:, c]
    return rows, cols, product


def _spread(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Connected parts of a two-sided graph: a label for each row and column (-1 without links)."""
    n = hit.shape[0]
    row = np.arange(n)
    while True:
        col = np.where(hit, row[:, None], n).min(axis=0)
        new = np.minimum(row, np.where(hit, col[None, :], n).min(axis=1))
        if (new == row).all():
            break
        row = new
    return np.where(hit.any(axis=1), row, -1), np.where(hit.any(axis=0), col, -1)


def compare(
    x: np.ndarray, y: np.ndarray | None, rotation: np.ndarray, sizes_x, sizes_y, ids_x, ids_y, least: float = LEAST,
    steps: tuple[int, ...] = (),
):
    """Links between two tiles (or within one, ``y`` None): ids, a representative and the weighted count of each."""
    inside = y is None
    if inside:
        y, sizes_y, ids_y = x, sizes_x, ids_x
    ux, uy = _unit(x), _unit(y)
    rx, ry = ux @ rotation, uy @ rotation
    d = x.shape[1]
    steps = sorted({min(s, d) for s in (*steps, d)})
    tail = lambda r: np.sqrt(np.stack([(r[:, s:] ** 2).sum(axis=1) for s in steps], axis=1)).astype(np.float32)
    tx, ty = tail(rx), tail(ry)
    rx, ry = rx.astype(np.float32), ry.astype(np.float32)
    margin = _margin(d)
    ox, oy = np.argsort(rx[:, 0], kind="stable"), np.argsort(ry[:, 0], kind="stable")
    count_x, count_y = np.zeros(len(x), np.int64), np.zeros(len(y), np.int64)
    parent: dict[int, int] = {}

    def root(i: int) -> int:
        parent.setdefault(i, i)
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for p in range(0, len(x), BLOCK):
        a = ox[p : p + BLOCK]
        for q in range(p if inside else 0, len(y), BLOCK):
            b = oy[q : q + BLOCK]
            rows, cols, bound = _links_of_block(rx[a], ry[b], tx[a], ty[b], steps, least)
            if not len(rows) or not (bound >= least - margin).any():
                continue
            i, j = a[rows], b[cols]
            cosine = ux[i] @ uy[j].T
            hit = cosine >= least
            for r, c in np.argwhere(np.abs(cosine - least) < _SLACK):  # near the threshold: in extended precision
                v, w = x[i[r]].astype(np.longdouble), y[j[c]].astype(np.longdouble)
                hit[r, c] = float((v * w).sum() / np.sqrt((v * v).sum() * (w * w).sum())) >= least
            if inside and p == q:
                hit &= i[:, None] != j[None, :]
            if not hit.any():
                continue
            np.add.at(count_x, i, hit @ sizes_y[j])
            if not (inside and p == q):
                np.add.at(count_y, j, hit.T @ sizes_x[i])
            row, col = _spread(hit)
            for at, label in [*zip(i[row >= 0], row[row >= 0])]:
                u, v = root(int(ids_x[at])), root(int(ids_x[i[label]]))
                parent[max(u, v)] = min(u, v)
            for at, label in [*zip(j[col >= 0], col[col >= 0])]:
                u, v = root(int(ids_y[at])), root(int(ids_x[i[label]]))
                parent[max(u, v)] = min(u, v)
    if inside:
        count_x = count_x + count_y
        ids, counts = ids_x, count_x
    else:
        ids, counts = np.concatenate([ids_x, ids_y]), np.concatenate([count_x, count_y])
    found = np.flatnonzero(counts)
    return ids[found], np.array([root(int(i)) for i in ids[found]], np.int64), counts[found]


def near_duplicates(vectors: DataFrame, least: float = LEAST, tile: int = TILE, leaves: int | None = None) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row for every row of ``vectors``."""
    spark = vectors.sparkSession
    packed = settle(_usable(vectors), "vectors")
    ours = F.col("length").isNotNull() & F.col("vec_id").isNotNull()
    classes = settle(
        packed.where(ours).groupBy("digest")
        .agg(F.min("vec_id").alias("low"), F.count("*").alias("size"), F.first("packed").alias("packed"), F.first("length").alias("length"))
        .withColumn("rep", F.monotonically_increasing_id()),
        "vector-classes",
    )
    # One number for each length that occurs.
    lengths = sorted(r["length"] for r in classes.groupBy("length").count().collect())
    found = None
    for length in lengths:
        links = _links(classes.where(F.col("length") == length), length, least, tile, leaves)
        found = links if found is None else found.unionByName(links)
    named = classes.select("digest", "rep", "low", "size")
    if found is not None:
        counts = found.groupBy("a").agg(F.sum("n").alias("n")).withColumnRenamed("a", "rep")
        named = named.join(counts, "rep", "left").join(lowest(classes, components(found.where("a <> b").select("a", "b"))), "rep", "left")
    else:
        named = named.withColumns({"n": F.lit(0), "component": F.col("low")})
    named = named.select(
        "digest", (F.coalesce("n", F.lit(0)) + F.col("size") - 1).cast("long").alias("links"),
        F.coalesce("component", "low").alias("component"),
    )
    own = packed.select("vec_id", F.when(ours, F.col("digest")).alias("digest"))
    return own.join(named, "digest", "left").select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
        F.coalesce(F.coalesce("component", "vec_id") == F.col("vec_id"), F.lit(True)).alias("kept"),
    )


def _links(classes: DataFrame, length: int, least: float, tile: int, leaves: int | None) -> DataFrame:
    """(a, b, n): vector a has n links in some pair of tiles and is connected to b by links there."""
    spark = classes.sparkSession
    context = spark.sparkContext

    def moments(batch):
        u = _unit(_matrix(batch.column("packed")))
        return (u.T @ u).ravel()

    total = summed(classes.select("packed"), moments, length * length).reshape(length, length)
    shares, rotation = np.linalg.eigh(total)
    shares, rotation = np.cumsum(shares[::-1]) / max(shares.sum(), 1e-300), rotation[:, ::-1]
    steps = tuple(int(np.searchsorted(shares, share)) + 1 for share in STOPS)
    n = classes.count()
    lead = min(LEAD, length)
    part = min(1.0, SAMPLE / max(n, 1))
    picked = classes.where(F.pmod(F.xxhash64("rep"), F.lit(1 << 20)) < int(part * (1 << 20))).select("packed").toArrow()
    sample = _unit(_matrix(picked.column("packed")))[:, :] @ rotation[:, :lead] if picked.num_rows else np.zeros((0, lead))
    wanted = leaves or min(LEAVES, max(1, -(-n // tile)))
    nodes = _cuts(sample, 1 << max(0, (wanted - 1).bit_length()))
    shared = context.broadcast((rotation, nodes))

    def home(batches):
        turn, cuts = shared.value
        for batch in batches:
            if batch.num_rows:
                y = _unit(_matrix(batch.column("packed"))) @ turn[:, :lead]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(x) for x in ("rep", "size", "packed")), pa.array(_leaf(y, cuts), pa.int32()),
                     pa.FixedSizeListArray.from_arrays(pa.array(y.ravel()), lead).cast(pa.list_(pa.float64()))],
                    ["rep", "size", "packed", "leaf", "lead"],
                )

    homed = settle(
        classes.select("rep", "size", "packed").mapInArrow(home, "rep long, size long, packed binary, leaf int, lead array<double>"),
        "vector-tiles",
    )
    ends = [f(F.col("lead")[i]).alias(f"{name}{i}") for i in range(lead) for name, f in (("low", F.min), ("high", F.max))]
    boxes = sorted(homed.groupBy("leaf").agg(F.count("*").alias("n"), *ends).collect(), key=lambda r: r["leaf"])  # LEAVES at most
    low = np.array([[r[f"low{i}"] for i in range(lead)] for r in boxes])
    high = np.array([[r[f"high{i}"] for i in range(lead)] for r in boxes])
    leaf_of = np.array([r["leaf"] for r in boxes])
    split = np.array([-(-r["n"] // tile) for r in boxes])
    first = np.concatenate([[0], np.cumsum(split)[:-1]])  # tiles are numbered leaf by leaf
    reach = 2 * (1 - least) + _SLACK  # squared distance of unit vectors at the threshold
    known = context.broadcast((low, high, leaf_of, first, split))

    def deal(batches):
        """Each vector once for every pair of its tile with a tile whose box it can reach."""
        lo, hi, leaves_, start, parts = known.value
        for batch in slices(batches, "packed", rows=2000):
            y = np.array(batch.column("lead").to_pylist())
            box = np.searchsorted(leaves_, batch.column("leaf").to_numpy())
            salt = np.array([xxhash.xxh32_intdigest(str(i)) for i in batch.column("rep").to_pylist()])
            own = start[box] + salt % parts[box]
            gap = np.zeros((len(y), len(lo)))
            for i in range(y.shape[1]):
                gap += np.maximum(np.maximum(lo[None, :, i] - y[:, i : i + 1], y[:, i : i + 1] - hi[None, :, i]), 0) ** 2
            row, near = np.nonzero(gap <= reach)
            times = parts[near]
            step = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            row, other = np.repeat(row, times), np.repeat(start[near], times) + step
            i, j = np.minimum(own[row], other), np.maximum(own[row], other)
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(own[row] == j), batch.column("rep").take(take),
                 batch.column("size").take(take), batch.column("packed").take(take)],
                ["i", "j", "second", "rep", "size", "packed"],
            )

    dealt = homed.mapInArrow(deal, "i int, j int, second boolean, rep long, size long, packed binary")

    def pair(group: pa.Table) -> pa.Table:
        turn = shared.value[0]
        x, sizes, ids = _matrix(group.column("packed")), group.column("size").to_numpy(), group.column("rep").to_numpy()
        order = np.argsort(ids, kind="stable")
        x, sizes, ids = x[order], sizes[order], ids[order]
        second = group.column("second").to_numpy(zero_copy_only=False)[order].astype(bool)
        if group.column("i")[0].as_py() == group.column("j")[0].as_py():
            a, b, n = compare(x, None, turn, sizes, None, ids, None, least, steps)
        elif second.all() or not second.any():
            a = b = n = np.empty(0, np.int64)
        else:
            f, s = ~second, second
            a, b, n = compare(x[f], x[s], turn, sizes[f], sizes[s], ids[f], ids[s], least, steps)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "n": pa.array(n, pa.int64())})

    return settle(dealt.groupBy("i", "j").applyInArrow(pair, "a long, b long, n long"), f"vector-links-{length}")
