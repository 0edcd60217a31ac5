"""Exact top-k by inner product: best-first search over paged M-trees.

Vectors are turned into whole numbers and lifted to one length by one more coordinate, sqrt(M^2 - |x|^2), so that the
largest inner products are the smallest distances and the triangle inequality holds. Vectors are dealt to cells by the
nearest of a few pivots (a sample, about one for each page); cells that are too large are dealt again by pivots of their own,
until each fits into a page. Only copies of one vector, which lie in a ball of radius 0, are cut by a hash. A task builds the
M-tree of a page: nodes hold routing vectors with a covering radius and the distance to the parent's routing vector, leaves
hold vectors with their distance to the leaf's routing vector.

A query first searches the page that it lies in, which gives its k-th best score so far. A directory of the pages' balls (a
row for each page) then tells which others may hold better ones; groups of pages without such a page never see the query.
In a group, a query keeps a heap of nodes by their least possible distance and stops when that is beyond its k-th best. A
child or vector is left out without computing its distance if the difference between the two stored or known distances to
the parent already puts it beyond. Pruning compares distances with a margin above rounding, scores are exact integers.

Defined results: vectors that are NULL, hold NULL, NaN or infinite components, or differ in length from most take no part,
neither as queries nor as candidates; a row is never its own candidate, but repeated rows are candidates of each other; ties
go to the smaller id, NULL ids last; fewer candidates than k give fewer rows; no rows give no rows. Extra columns are not
looked at. Components times the scale must stay below 2^20 in size, so that sums of products fit into a long.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import stage_table

#: Least and most vectors of a page, pages that a table is cut into at least and at most (before the bounds of a page).
SMALL, LARGE, FEW, MANY = 2_048, 65_536, 8, 65_536
#: Entries of a leaf, children of an inner node, vectors in a group of pages, queries in a block, rounds of cutting cells.
LEAF, FAN, GROUP, BLOCK, ROUNDS = 128, 16, 65_536, 8_192, 6
NO_ID = np.iinfo(np.int64).max


def whole_vectors(table: DataFrame, is_query: Column, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(row, id, asks, v: array of floor(scale * x)) of the vectors that take part."""
    x = F.col("x")
    sound = x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = table.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).cast("bigint").alias("id"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
        F.col(vector_col).cast("array<double>").alias("x"),
    )
    return rows.where(sound).select("row", "id", "asks", F.transform("x", lambda c: F.floor(c * scale)).alias("v"))


class Page:
    """An M-tree in arrays. Node n: routing vector, radius, and children (numbers, distances to n's routing vector, radii) or entries.

    Vectors lie in the order of the leaves, and in a leaf in the order of their distances to its routing vector, so that
    the entries which the triangle inequality leaves are one slice. They are whole numbers in doubles, which hold the sums
    of their products exactly.
    """

    def __init__(self, vectors: np.ndarray, lift: np.ndarray, rows: np.ndarray, ids: np.ndarray):
        self.vectors, self.lift = vectors.astype(float), lift
        self.routing: list[int] = []
        self.radius: list[float] = []
        self.children: list[tuple[np.ndarray, np.ndarray, np.ndarray] | None] = []
        self.entries: list[tuple[int, int]] = []
        self.order: list[np.ndarray] = []
        self.far: list[np.ndarray] = []
        self._placed = 0
        every = np.arange(len(vectors))
        self._grow(every, self._middle(every))
        order = np.concatenate(self.order)
        self.routes = self.vectors[self.routing]
        self.vectors, self.rows, self.ids, self.to_routing = self.vectors[order], rows[order], ids[order], np.concatenate(self.far)
        del self.order, self.far, self.lift, self.routing, self._placed
        self._link()

    def _link(self) -> None:
        """Routing vectors of each node's children side by side."""
        self.child_routes = [None if c is None else self.routes[c[0]] for c in self.children]

    def pack(self) -> bytes:
        small = {k: v.astype(np.int32) for k, v in (("vectors", self.vectors), ("routes", self.routes))}
        return pickle.dumps({k: v for k, v in self.__dict__.items() if k != "child_routes"} | small)

    @classmethod
    def unpack(cls, blob: bytes) -> Page:
        page = cls.__new__(cls)
        page.__dict__.update(pickle.loads(blob))
        page.vectors, page.routes = page.vectors.astype(float), page.routes.astype(float)
        page._link()
        return page

    def _distances(self, at: np.ndarray, to: int) -> np.ndarray:
        d = self.vectors[at] - self.vectors[to]
        return np.sqrt((d * d).sum(1) + (self.lift[at] - self.lift[to]) ** 2)

    def _middle(self, at: np.ndarray) -> int:
        few = at[:: max(1, len(at) // 16)][:16]
        return int(min(few, key=lambda c: self._distances(at, c).max()))

    def _grow(self, at: np.ndarray, routing: int) -> int:
        n = len(self.routing)
        far = self._distances(at, routing)
        self.routing.append(routing)
        self.radius.append(float(far.max()))
        self.children.append(None)
        self.entries.append((0, 0))
        if len(at) <= LEAF or far.max() == 0:
            order = np.argsort(far, kind="stable")
            self.order.append(at[order])
            self.far.append(far[order])
            self.entries[n] = self._placed, self._placed + len(at)
            self._placed += len(at)
            return n
        centres = [int(at[far.argmax()])]  # centres far from each other
        owner = np.zeros(len(at), np.int64)
        near = self._distances(at, centres[0])
        while len(centres) < FAN and near.max() > 0:
            centres.append(int(at[near.argmax()]))
            d = self._distances(at, centres[-1])
            owner[d < near] = len(centres) - 1
            near = np.minimum(near, d)
        kids = []
        for c in range(len(centres)):
            mine = at[owner == c]
            if len(mine):
                middle = self._middle(mine)
                kids.append((self._grow(mine, middle), float(self._distances(np.array([middle]), routing)[0])))
        numbers = np.array([k for k, _ in kids])
        self.children[n] = numbers, np.array([d for _, d in kids]), np.array([self.radius[k] for k in numbers])
        return n


def search(pages: list[Page], roots: np.ndarray, query: np.ndarray, norm: float, top: int, own: int, floor: int | None) -> tuple[list[tuple[int, int, int]], int]:
    """The ``top`` best (score, id, row) of the pages, and how many distances were computed.

    ``roots``: products of the query with the roots' routing vectors, NaN for pages that are not to be searched; ``norm``:
    |query|^2 + M^2; ``floor``: a score that ``top`` candidates reach.
    """
    best: list[tuple[int, int, int]] = []  # a heap of (score, -id, -row), worst first
    done = int(np.count_nonzero(roots == roots))

    def reach() -> float:
        """Distance of the k-th best score with a margin above rounding."""
        score = best[0][0] if len(best) == top else floor
        if len(best) == top and floor is not None:
            score = max(score, floor)
        if score is None:
            return float("inf")
        d = max(0.0, norm - 2.0 * score) ** 0.5
        return d + 1e-6 * (1 + d) + 1e-3

    heap = []
    for p, (page, ip) in enumerate(zip(pages, roots.tolist())):
        if ip != ip:
            continue
        d = max(0.0, norm - 2.0 * ip) ** 0.5
        heap.append((max(0.0, d - page.radius[0]), p, 0, d))
    heapq.heapify(heap)
    limit = reach()
    while heap:
        least, p, n, d = heapq.heappop(heap)
        if least > limit:
            break
        page = pages[p]
        if page.children[n] is not None:
            numbers, parent, radius = page.children[n]
            near = np.abs(d - parent) - radius <= limit
            if near.all():
                routes = page.child_routes[n]
            else:
                numbers, radius, routes = numbers[near], radius[near], page.child_routes[n][near]
            done += len(numbers)
            far = np.sqrt(np.maximum(0.0, norm - 2.0 * (routes @ query)))
            bound = np.maximum(0.0, far - radius)
            for c, x, y in zip(numbers.tolist(), bound.tolist(), far.tolist()):
                if x <= limit:
                    heapq.heappush(heap, (x, p, c, y))
            continue
        start, stop = page.entries[n]
        known = page.to_routing[start:stop]
        a, b = (start + known.searchsorted((d - limit, d + limit))).tolist()  # the limit has a margin, so ends do not matter
        if a >= b:
            continue
        done += b - a
        scores = page.vectors[a:b] @ query
        worst = best[0][0] if len(best) == top else -np.inf
        worst = worst if floor is None or floor < worst else floor
        good = (scores >= worst).nonzero()[0]
        if not len(good):
            continue
        for k in good.tolist():
            row = int(page.rows[a + k])
            if row == own:
                continue
            item = (int(scores[k]), -int(page.ids[a + k]), -row)
            if len(best) < top:
                heapq.heappush(best, item)
            elif item > best[0]:
                heapq.heapreplace(best, item)
        limit = reach()
    return sorted(((s, -i, -r) for s, i, r in best), key=lambda b: (-b[0], b[1], b[2])), done


def _matrix(column, size: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy().reshape(len(flat), size)


def _distances(v: np.ndarray, to: np.ndarray, longest: float) -> np.ndarray:
    """[vector, pivot] distances of lifted vectors."""
    square, squares = (v * v).sum(1), (to * to).sum(1)
    lift, lifts = np.sqrt(np.maximum(0, longest - square)), np.sqrt(np.maximum(0, longest - squares))
    near = square[:, None] + squares[None, :] - 2 * (v @ to.T)
    return np.sqrt(np.maximum(0, near) + (lift[:, None] - lifts[None, :]) ** 2)


def _cells(rows: DataFrame, size: int, longest: float, page: int) -> tuple[DataFrame, dict[int, int]]:
    """The rows with their ``cell``, and the size of every cell.

    Rows of cells that exceed a page are dealt anew to pivots of their own cell, about one for each page that it fills; what
    is collected are a pivot and a size for each cell. Cells of copies of one vector stay whole.
    """
    schema, kept = "row bigint, id bigint, asks boolean, v array<bigint>, cell bigint, far double", ["row", "id", "asks", "v"]
    celled = rows.select("*", F.lit(0).cast("bigint").alias("cell"), F.lit(1.0).alias("far"))
    large, done, names = {0: rows.count()}, {}, 1
    for _ in range(ROUNDS):
        share = F.create_map(*[F.lit(x) for c, n in large.items() for x in (c, -(-n // page) / n)])
        luck = F.pmod(F.xxhash64("row", F.lit(names)), F.lit(1 << 30)) / F.lit(1 << 30)
        drawn = celled.where(F.col("cell").isin(*large)).where(luck < share[F.col("cell")]).select("cell", "v").distinct().collect()
        pivots: dict[int, list] = {}
        for cell, v in drawn:
            pivots.setdefault(cell, []).append(v)
        first = {}
        for cell, own in pivots.items():
            first[cell], names = names, names + len(own)
        sent = rows.sparkSession.sparkContext.broadcast({c: (first[c], np.array(own, np.int64).reshape(-1, size)) for c, own in pivots.items()})

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                v = _matrix(batch.column("v"), size).astype(float)
                cell, far = batch.column("cell").to_numpy().copy(), batch.column("far").to_numpy(zero_copy_only=False).copy()
                for c in np.unique(cell):
                    if int(c) in sent.value:
                        base, to = sent.value[int(c)]
                        mine = np.flatnonzero(cell == c)
                        d = _distances(v[mine], to.astype(float), longest)
                        cell[mine], far[mine] = base + d.argmin(1), d.min(1)
                yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in kept), pa.array(cell), pa.array(far)], [*kept, "cell", "far"])

        celled = stage_table(celled.mapInArrow(deal, schema))
        found = celled.groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("far")).collect()
        done = {r.cell: r.n for r in found}
        large = {r.cell: r.n for r in found if r.n > 2 * page and r.far > 1e-3}
        if not large:
            break
    return celled, done


def top_k(
    table: DataFrame, is_query: Column, k: int = 5, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", page: int | None = None
) -> DataFrame:
    """(query_row, query_id, rank, id, score, computed): the k best of every row for which ``is_query`` holds.

    ``computed`` is the number of distances that the query's searches needed, without the look at the directory.
    """
    spark = table.sparkSession
    rows = stage_table(whole_vectors(table, is_query, id_col, vector_col, scale))
    lengths = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    size = lengths[0] if lengths else 0
    rows = rows.where(F.size("v") == size)
    square = F.aggregate("v", F.lit(0).cast("bigint"), lambda a, x: a + x * x)
    facts = rows.agg(F.count("*").alias("n"), F.max(square).alias("most"), F.count_if("asks").alias("asks")).first()
    longest = float(facts.most or 0)
    page = page or max(SMALL, min(facts.n // FEW, LARGE), facts.n // MANY)
    celled, sizes = _cells(rows, size, longest, page) if facts.n else (rows.select("*", F.lit(0).cast("bigint").alias("cell")), {})
    pieces = spark.createDataFrame([(c, max(1, round(n / page))) for c, n in sizes.items() if n > 2 * page], "cell bigint, pieces bigint")
    cut = F.pmod(F.xxhash64("row"), F.coalesce("pieces", F.lit(1)))
    placed = celled.join(F.broadcast(pieces), "cell", "left").select("row", "id", "asks", "v", (F.col("cell") * 65_536 + cut).alias("page"))

    def build(table: pa.Table) -> pa.Table:
        v = _matrix(table.column("v"), size)
        lift = np.sqrt(np.maximum(0.0, longest - (v * v).sum(1)))
        ids = np.array([NO_ID if i is None else i for i in table.column("id").to_pylist()], np.int64)
        tree = Page(v, lift, table.column("row").to_numpy(), ids)
        ball = [pa.array([tree.routes[0].astype(np.int64)], pa.list_(pa.int64())), pa.array([tree.radius[0]])]
        return pa.table([table.column("page")[:1], pa.array([tree.pack()], pa.binary()), *ball], names=["page", "tree", "route", "radius"])

    pages = stage_table(placed.groupBy("page").applyInArrow(build, "page bigint, tree binary, route array<bigint>, radius double"))
    balls = pages.select("page", "route", "radius").orderBy("page").collect()  # a row for each page
    groups = max(1, -(-facts.n // GROUP), min(int(spark.conf.get("spark.sql.shuffle.partitions")), len(balls) // 2))
    group_of = {b.page: i % groups for i, b in enumerate(balls)}
    directory = spark.sparkContext.broadcast(
        (np.array([b.page for b in balls]), np.array([b.route for b in balls], float).reshape(len(balls), size), np.array([b.radius for b in balls]), np.array(list(group_of.values())))
    )
    kind = "query_row bigint, query_id bigint, id bigint, row bigint, score bigint, computed bigint"

    def answer(trees: pa.Table, questions: pa.Table) -> pa.Table:
        found = {c: [] for c in ("query_row", "query_id", "id", "row", "score", "computed")}
        opened = [Page.unpack(blob) for blob in trees.column("tree").to_pylist()]
        numbers = trees.column("page").to_numpy()
        if opened and questions.num_rows:
            vectors = _matrix(questions.column("v"), size).astype(float)
            roots = vectors @ np.stack([p.routes[0] for p in opened]).T
            own = questions.column("page").to_numpy()[:, None] == numbers[None, :]
            second = np.array([f is not None for f in questions.column("again").to_pylist()])
            roots[own & second[:, None]] = np.nan  # searched before
            floors = questions.column("floor").to_pylist()
            for row, i, q, products, floor in zip(questions.column("row").to_pylist(), questions.column("id").to_pylist(), vectors, roots, floors):
                got, computed = search(opened, products, q, float(q @ q) + longest, k, row, floor)
                got = got or [(None, None, None)]  # says what was computed
                for at, (score, j, r) in enumerate(got):
                    for c, x in zip(found, (row, i, None if j == NO_ID else j, r, score, 0 if at else computed)):
                        found[c].append(x)
        return pa.table({c: pa.array(v, pa.int64()) for c, v in found.items()})

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The groups with a page that may hold a better vector than the k-th best so far."""
        numbers, routes, radius, group = directory.value
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                q = _matrix(part.column("v"), size).astype(float)
                floor = part.column("floor").fill_null(-(1 << 52)).to_numpy(zero_copy_only=False).astype(float)
                norm = (q * q).sum(1) + longest
                reach = np.sqrt(np.maximum(0, norm - 2 * floor))
                near = np.sqrt(np.maximum(0, norm[:, None] - 2 * (q @ routes.T))) - radius <= (reach * (1 + 2e-6) + 2e-3)[:, None]
                near &= part.column("page").to_numpy()[:, None] != numbers[None, :]
                lists = [np.unique(group[n]).tolist() for n in near]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(lists, pa.list_(pa.int32()))], [*part.schema.names, "groups"])

    # First the page of its own, cut into blocks where many queries lie.
    asked = placed.where("asks").select("row", "id", "v", "page")
    crowds = asked.groupBy("page").agg((F.floor(F.count("*") / BLOCK) + 1).alias("blocks"))
    crowds = stage_table(crowds.join(pages.select("page", "tree"), "page").select("page", "tree", "blocks"))
    mine = asked.join(crowds.select("page", "blocks").hint("shuffle_hash"), "page").withColumn("block", F.pmod(F.xxhash64("row"), "blocks"))
    mine = mine.select("row", "id", "v", "page", "block", F.lit(None).cast("int").alias("again"), F.lit(None).cast("bigint").alias("floor"))
    trees = crowds.select("page", "tree", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("block"))
    first = stage_table(trees.groupBy("page", "block").cogroup(mine.groupBy("page", "block")).applyInArrow(answer, kind))
    least = first.groupBy(F.col("query_row").alias("row")).agg(F.when(F.count("score") >= k, F.min("score")).alias("floor"))
    # Then all others that its k-th best so far allows.
    blocks = max(1, -(-facts.asks // BLOCK), min(facts.asks // 64, -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // groups)))
    routed = asked.join(least, "row").mapInArrow(route, "row bigint, id bigint, v array<bigint>, page bigint, floor bigint, groups array<int>")
    routed = routed.select("row", "id", "v", "page", F.lit(1).alias("again"), "floor", F.explode("groups").alias("group"), F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias("block"))
    held = spark.createDataFrame(list(group_of.items()), "page bigint, group int")
    left = pages.join(F.broadcast(held), "page").select("page", "tree", "group", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    others = left.groupBy("group", "block").cogroup(routed.groupBy("group", "block")).applyInArrow(answer, kind)
    by = Window.partitionBy("query_row")
    order = by.orderBy(F.col("score").desc_nulls_last(), F.col("id").asc_nulls_last(), "row")
    answers = first.unionByName(others).withColumn("computed", F.sum("computed").over(by)).withColumn("rank", F.row_number().over(order))
    return answers.where((F.col("rank") <= k) & F.col("score").isNotNull()).select("query_row", "query_id", "rank", "id", "score", "computed")
