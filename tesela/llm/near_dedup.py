"""Near-duplicate documents by a chosen-path set similarity join (after Christiani, Pagh and Sivertsen,
Scalable and Robust Set Similarity Join, 2018).

1. One scan shingles each whole text and takes a one-permutation MinHash signature from the sorted hashes.
   Documents with one and the same set fold into a node, named by a hash of the set.
2. `trees` independent trees branch the nodes: each tree has coordinates of the signature of its own. A branch picks one that
   its path has not used, and a second one with the chance that keeps a pair at the threshold alive, and a set goes to the
   child that its minwise token there names. Children are counted before anything wide moves; single sets
   leave, those of up to `leaf` sets are compared exhaustively, larger ones branch on.
3. Leaves first compare one byte of each coordinate, then the lowest tokens of sets. A pair is likely down to six standard
   deviations below the threshold, so the comparison itself loses about one pair in 10 ** 9 at the threshold, and none that
   are much closer.
4. What is still larger at `depth`, or is hardly parted by branching, is compared exhaustively, so no cap loses a pair: nodes that
   trees have in common are united; all with the least set and in pieces first, then all sets that links so far leave in
   different components, on lines of an affine plane.
5. A leaf first gives a spanning forest of its likely pairs, not all pairs; they are confirmed on full sets.
   A second look, by lowest tokens, at the sets that likely pairs connect gives every likely pair that the confirmed links leave
   in two components; sets of up to LOWEST shingles are compared whole there. The same sets, met in several trees, are looked at once.
6. Components come from distributed star contraction. Nothing grows on the driver.

Recall: of a pair at the very threshold (0.85) a tree keeps the two together through a branching with the chance of 0.85, more for
closer ones. With the second coordinate on average one path survives each level, and at least one does through k levels with a
chance of 0.87, 0.78, 0.70, 0.64, 0.58, 0.54 for k = 1 .. 6. Nearly all leaves are one or two levels deep, where 16 trees
miss less than one pair in 10 ** 10; at the full depth of 6 they miss (1 - 0.54) ** 16, four pairs in a million, unless other links join it.

Hash sets stand for word sets (64 bits a shingle, made of 64-bit hashes of words that nobody can make collide on purpose).

Defined cases: a null text or one without words has no shingles and links with nothing. Rows without an id
cannot be named: they get n_shingles, a null component_id and stay. Rows that share a doc_id are judged each by its own
text; repeated rows are judged alike. An empty table gives an empty result. Other columns
are ignored.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bitmap, bits_for, bytes_of, clear_scratch, drop, few, give_back, kept_at, marked, scratch_mark, sliced, slot, small_batches, stored
from .common import suspects as _suspects
from .components import components
from .shingles import mix, shingle_sets

COORDS = 128
#: Tokens that the second look compares: the lowest of a set, all of a set that has no more.
LOWEST = 384
#: Standard deviations below the threshold that a pair of signatures may fall before it is not likely.
SLACK = 6
#: Rows of one set that a task joins at once; a set with more is sent to several.
HUB = 512
#: Rows with sketches, and with full sets, that a task takes where the shuffle has more partitions than these need.
SKETCHES, FULL = 5_000, 1_000
#: Sets, and shingles, of a block of linked sets whose pairs are confirmed together with those of another block.
CELL, CELL_SHINGLES = 64, 1 << 19


suspects = functools.partial(_suspects, thin=True)


def _detours() -> np.ndarray:
    """For each coordinate the order in which it tries others when its own bin is empty (Shrivastava,
    Optimal Densification, 2017)."""
    keys = mix(np.arange(COORDS * COORDS, dtype=np.uint64) + np.uint64(77)).reshape(COORDS, COORDS)
    return np.argsort(keys, axis=1, kind="stable")


_DETOURS = _detours()
_EDGES = (np.arange(COORDS, dtype=np.uint64) << np.uint64(57)).astype(np.uint64)


def signature(shingles: np.ndarray) -> np.ndarray:
    """COORDS minwise tokens of 32 bits from a sorted, non-empty array: the least hash of each of COORDS equal
    ranges; an empty range takes the token of the first filled one in its detour."""
    at = np.searchsorted(shingles, _EDGES)
    end = np.append(at[1:], len(shingles))
    filled = end > at
    tokens = mix(shingles[np.minimum(at, len(shingles) - 1)]).astype(np.uint32)
    if filled.all():
        return tokens
    source = _DETOURS[np.arange(COORDS), np.argmax(filled[_DETOURS], axis=1)]
    return tokens[np.where(filled, np.arange(COORDS), source)]


def packed(shingles: np.ndarray) -> bytes:
    """The highest 24 bits of the LOWEST lowest hashes of a sorted array, three bytes each."""
    return (shingles[:LOWEST] >> np.uint64(40)).astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3].tobytes()


def unpacked(low: bytes) -> np.ndarray:
    """The distinct tokens that packed() holds, sorted. Tokens of two hashes coincide once in 2 ** 24, which may raise a similarity
    and lowers one by less than the slack of likely_by_least()."""
    out = np.zeros((len(low) // 3, 4), np.uint8)
    out[:, :3] = np.frombuffer(low, np.uint8).reshape(-1, 3)
    return np.unique(out.view("<u4").ravel())


def _set_key(shingles: np.ndarray) -> bytes | None:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, "text", 1 << 19):
        sets = shingle_sets(*bytes_of(batch.column("text")))
        signs = [signature(s) if len(s) else None for s in sets]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("text_key"),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([_set_key(s) for s in sets], pa.binary()),
                pa.array([None if s is None else s.tobytes() for s in signs], pa.binary()),
                pa.array([None if s is None else s.astype(np.uint8).tobytes() for s in signs], pa.binary()),
                pa.array([packed(s) for s in sets], pa.binary()),
            ],
            ["doc_id", "text_key", "n_shingles", "set_key", "sig", "low", "least"],
        )


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, "text", 1 << 19):
        sets = [s for s in shingle_sets(*bytes_of(batch.column("text"))) if len(s)]
        names = [int.from_bytes(_set_key(s)[:8], "big", signed=True) for s in sets]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], ["rep", "shingles"])


def _branch(rows: DataFrame, share: float, trees: int) -> DataFrame:
    """rows: node, tree, used, rep, held, sig. Children by one coordinate of the node's choice among those of its tree that its path has
    not used and, for `share` of the nodes, by a second one."""
    own = max(1, COORDS // trees)
    free = F.array_except(F.sequence(F.lit(0), F.lit(own - 1)), "used")
    rows = rows.withColumn("free", F.when(F.size(free) > 0, free).otherwise(F.sequence(F.lit(0), F.lit(own - 1))))
    pick = lambda k: F.get("free", F.pmod(F.xxhash64("node", F.lit(k)), F.size("free").cast("long")).cast("int"))
    second = (F.pmod(F.xxhash64("node", F.lit(3)), F.lit(10_000).cast("long")) < int(10_000 * share)) & (pick(1) != pick(2))
    coords = F.when(second, F.array(pick(1), pick(2))).otherwise(F.array(pick(1)))
    rows = rows.select("node", "tree", "used", "rep", "held", "sig", F.explode(coords).alias("k"))
    token = F.expr(f"substring(sig, CAST((tree * {own} + k) % {COORDS} AS INT) * 4 + 1, 4)")
    return rows.select(F.xxhash64("node", "k", token).alias("node"), "tree", F.concat("used", F.array("k")).alias("used"), "rep", "held")


def _shared(rows: DataFrame, many: int) -> DataFrame:
    """rows (node, tree, used, rep, held), about `many`, with the size n of their node; those alone in it are gone. Only rows whose node may hold
    another one are shuffled for the join."""
    sizes = stored(few(rows.groupBy("node").agg(F.count("*").alias("n")).where("n > 1"), many), "op3-sizes")
    return few(suspects(rows, "node", sizes.select("node"))[0].join(sizes, "node"), many)


def likely(lows: np.ndarray, sizes: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs i < j that may reach the threshold by the bytes of their coordinates and their sizes, and the share of equal
    coordinates. A set has about as many independent coordinates as half its shingles, COORDS at most."""
    share = percent / 100
    small, large = np.minimum.outer(sizes, sizes), np.maximum.outer(sizes, sizes)
    like = np.empty(large.shape)
    for k in range(0, len(lows), 64):  # 64 x n x COORDS bytes at once
        like[k : k + 64] = np.count_nonzero(lows[k : k + 64, None] == lows[None], axis=2) / COORDS
    least = share - SLACK * np.sqrt(share * (1 - share) / np.minimum(COORDS, large / 2))
    i, j = np.nonzero(np.triu((like >= least) & (100 * small >= percent * large), 1))
    return i, j, like[i, j]


def likely_by_least(lows: list[np.ndarray], sizes: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """likely() by lowest tokens. Below the lesser of two sketches' ends both are complete: the similarity is exact where the
    sketches are the whole sets. Tokens that a single sketch has are counted and not laid out."""
    whole = sizes <= LOWEST
    ends = np.array([0xFFFFFFFF if w else int(x[-1]) for w, x in zip(whole, lows, strict=True)], np.int64)
    _, at, often = np.unique(np.concatenate(lows), return_inverse=True, return_counts=True)
    column, row = np.cumsum(often > 1) - 1, np.repeat(np.arange(len(lows)), [len(x) for x in lows])
    some = often[at] > 1
    laid = np.zeros((len(lows), int((often > 1).sum())), np.float32)
    laid[row[some], column[at[some]]] = 1
    both = laid @ laid.T
    upto = np.array([np.searchsorted(x, ends, "right") for x in lows])
    union = upto + upto.T - both
    like, share = both / np.maximum(union, 1), percent / 100
    spread = np.where(whole[:, None] & whole[None, :], 0.01, SLACK * np.sqrt(share * (1 - share) / np.maximum(union, 1)))
    small, large = np.minimum.outer(sizes, sizes), np.maximum.outer(sizes, sizes)
    i, j = np.nonzero(np.triu((like >= share - spread) & (100 * small >= percent * large), 1))
    return i, j, like[i, j]


def _find(parent: dict, x: int) -> int:
    while parent.setdefault(x, x) != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def _leaf_pairs(percent: int, everything: bool):
    """For rows node, rep, comp, n_shingles, sketch sorted by node: likely pairs a < b of different comp in one node. Without
    `everything`, likeliest first, only those that join sets which earlier ones leave apart, as rows node, root, a, b: sets that
    likely pairs connect have one root in their node."""

    def pairs_of(node: int, reps: list, comps: list, sizes: list, lows: list) -> Iterator[tuple]:
        if len(reps) < 2 or len(set(comps)) < 2:
            return
        if everything:
            i, j, n = likely_by_least([unpacked(x) for x in lows], np.array(sizes), percent)
        else:
            i, j, n = likely(np.frombuffer(b"".join(lows), np.uint8).reshape(-1, COORDS), np.array(sizes), percent)
        order = np.argsort(-n, kind="stable")
        parent: dict[int, int] = {}
        forest = []
        for x, y in zip(i[order].tolist(), j[order].tolist(), strict=True):
            if comps[x] == comps[y] or reps[x] == reps[y]:
                continue
            pair = min(reps[x], reps[y]), max(reps[x], reps[y])
            if everything:
                yield pair
                continue
            a, b = _find(parent, reps[x]), _find(parent, reps[y])
            if a != b:
                parent[a] = b
                forest.append(pair)
        for a, b in forest:
            yield node, _find(parent, a), a, b

    columns = ("a", "b") if everything else ("node", "root", "a", "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[list] = [[], [], [], [], []]
        for batch in batches:
            new = [batch.column(c).to_pylist() for c in ("node", "rep", "comp", "n_shingles", "sketch")]
            rest = [x + y for x, y in zip(rest, new, strict=True)]
            nodes = rest[0]
            cuts = [0, *[k for k in range(1, len(nodes)) if nodes[k] != nodes[k - 1]]]
            found = [p for a, z in zip(cuts[:-1], cuts[1:], strict=True) for p in pairs_of(nodes[a], *[x[a:z] for x in rest[1:]])]
            rest = [x[cuts[-1] :] for x in rest]
            yield _pairs(found, columns)
        if rest[0]:
            yield _pairs(list(pairs_of(rest[0][0], *rest[1:])), columns)
        rest = []
        give_back()

    return run


def _pairs(found: list[tuple], columns: tuple = ("a", "b")) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in range(len(columns))], list(columns))


def _confirm(percent: int):
    """For rows cell, rep, others, shingles sorted by cell: the pairs of a rep and one of its others that reach the threshold. An other
    one is in the same cell."""

    def links(rows: list[tuple]) -> list[tuple]:
        sets = {rep: np.frombuffer(s, np.uint64) for rep, _, s in rows}
        found = []
        for a, others, _ in rows:
            for b in others:
                both = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    found.append((a, b))
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, rest = None, []
        for batch in (whole.slice(at, 64) for whole in batches for at in range(0, whole.num_rows, 64)):
            found = []
            for new, *row in zip(*[batch.column(c).to_pylist() for c in ("cell", "rep", "others", "shingles")], strict=True):
                if new != cell:
                    found += links(rest)
                    cell, rest = new, []
                rest.append(row)
            yield _pairs(found)
        yield _pairs(links(rest))
        rest = []
        give_back()

    return run


def _order(sets: Column, leaf: int) -> Column:
    """The least prime q for which q lines of about `leaf` sets hold so many, or 1 where one does; a prime lies between m and 2 m."""
    m = F.ceil(sets / F.lit(leaf)).cast("long")
    prime = lambda c: F.forall(F.sequence(F.lit(2).cast("long"), F.greatest(F.lit(2).cast("long"), F.floor(F.sqrt(c)))), lambda d: (c % d != 0) | (c == d))
    return F.when(m < 2, F.lit(1).cast("long")).otherwise(F.element_at(F.filter(F.sequence(m, 2 * m), prime), 1))


def _lines(rows: DataFrame, leaf: int) -> DataFrame:
    """(node, rep) for rows (node, rep): a new node for each line of an affine plane of order q over the sets of a node, which its points
    hold by hash. Any two points lie on a line, so any two sets meet; a line holds about `leaf` sets, a set is on q + 1."""
    many = rows.count()
    order = few(rows.groupBy("node").agg(_order(F.count("*"), leaf).alias("q")), many)
    x, y = [F.pmod(F.xxhash64("rep", F.lit(k)), F.col("q")) for k in (5, 6)]
    points = few(rows.join(order, "node"), many).select("node", "rep", "q", x.alias("x"), y.alias("y"))
    slopes = F.explode(F.when(F.col("q") > 1, F.sequence(F.lit(0).cast("long"), F.col("q"))).otherwise(F.array(F.lit(0).cast("long")))).alias("slope")
    cut = F.when(F.col("slope") == F.col("q"), F.col("x")).otherwise(F.pmod(F.col("y") - F.col("slope") * F.col("x"), F.col("q")))
    return points.select("node", "rep", "q", "x", "y", slopes).select(F.xxhash64("node", "slope", cut, F.lit(8)).alias("node"), "rep")


def _united(rows: DataFrame, leaf: int, rounds: int = 1) -> tuple[DataFrame, DataFrame]:
    """For rows (node, rep): (name, rep), the union of nodes that share a minwise set in place of them where its lines hold no more rows
    than theirs, and (node, name, cost, held): the rows of a union's lines, and those of its nodes.

    Trees meet a large group with nearly the same sets again and again. Each pair of a node is in its union."""
    cost = lambda n: n * (_order(n, leaf) + 1)
    spark, mark = rows.sparkSession, scratch_mark()
    tasks = rows.count() // 100_000 + 1
    few = lambda df: df.coalesce(tasks)  # noqa: E731  these tables are narrow and small: no file for each of many tasks
    sets = few(rows.select(F.col("node").alias("name"), "rep"))
    names = stored(few(sets.groupBy("name").agg(F.count("*").alias("held"))).select(F.col("name").alias("node"), "name", "held"), "op3-nodes")
    for k in range(rounds):
        keys = stored(few(sets.groupBy("name").agg(F.min(F.xxhash64("rep", F.lit(100 + k))).alias("least"), F.count("*").alias("m"))), "op3-least")
        apart = few(keys.groupBy("least").agg(F.sum(cost(F.col("m"))).alias("apart"), F.count("*").alias("nodes"))).where("nodes > 1")
        some = few(keys.join(apart.select("least"), "least")).select("name", "least")
        union = few(few(sets.join(some, "name").select("least", "rep").distinct()).groupBy("least").agg(F.count("*").alias("u")))
        joined = few(apart.join(union, "least")).where(cost(F.col("u")) <= F.col("apart")).select("least")
        to = stored(few(some.join(joined, "least")).select("name", F.xxhash64("least", F.lit(k), F.lit(9)).alias("to")), "op3-unions")
        if to.isEmpty():
            continue
        new = F.coalesce("to", "name").alias("name")
        sets = stored(few(few(sets.join(to, "name", "left")).select(new, "rep").distinct()), "op3-united")
        names = stored(few(names.join(to, "name", "left")).select("node", new, "held"), "op3-names")
    unions = few(sets.groupBy("name").agg(cost(F.count("*")).alias("cost"))).join(few(names.groupBy("name").agg(F.sum("held").alias("held"))), "name")
    names, names_at = kept_at(few(names.select("node", "name").join(unions, "name")), "op3-costs")
    sets, sets_at = kept_at(sets, "op3-unions")
    clear_scratch(spark, mark, {names_at, sets_at})
    return sets, names


def _leaves(reps: DataFrame, trees: int, leaf: int, depth: int, percent: int) -> tuple[DataFrame, DataFrame | None]:
    """(node, rep) of the leaves that hold two or more, and (node, rep) of larger nodes that do not branch on: those at `depth`, those
    that lost so few sets in the last branching that another one would make more rows than it saves in blocks, and
    unions of nodes of all trees whose lines hold no more rows than the next branching of these nodes.

    Lines of a node of n sets hold about n * n / leaf rows. Another branching makes n * reach rows; with the part r of its sets
    that the node kept of `held` ones before, its children's lines then hold reach * r * r of those rows."""
    reach = 100 / percent
    n, kept = F.col("n"), F.col("n") / F.col("held")
    idle = F.coalesce(n * (1 - reach * kept * kept) <= reach * leaf, F.lit(False))
    tree = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(trees - 1).cast("long")))
    large = reps.select(tree.alias("tree"), "rep", "sig").select(F.col("tree").alias("node"), "tree", F.array().cast("array<int>").alias("used"), "rep", F.lit(None).cast("long").alias("held"), "sig")
    done = over = None
    many, found = reps.count() * trees, 0
    for level in range(depth):
        rows, at, many = _branch(large, reach - 1, trees), None, int(many * reach)
        if level:
            rows, at = kept_at(few(rows.distinct(), many), f"op3-paths{level}")
        rows = stored(_shared(rows, many), f"op3-level{level}")
        many = rows.count()
        found += many
        if at:
            drop(reps.sparkSession, at)
        small = rows.where(n <= leaf).select("node", "rep")
        done = small if done is None else done.unionByName(small)
        large = rows.where(n > leaf)
        if large.isEmpty():
            break
        sets, names = _united(large.select("node", "rep"), leaf, 1 if level else 2)
        together = F.col("cost") <= reach * F.col("held")
        left = few(sets.join(few(names.where(together).select("name").distinct(), many), "name", "left_semi"), many).select(F.col("name").alias("node"), "rep")
        large = stored(few(large.join(names.where(~together).select("node"), "node"), many), "op3-large")
        stays = idle if level + 1 < depth else F.lit(True)
        left = left.unionByName(large.where(stays).select("node", "rep"))
        over = left if over is None else over.unionByName(left)
        large = large.where(~stays)
        many = large.count()
        signs = suspects(reps.select("rep", "sig"), "rep", stored(few(large.select("rep").distinct(), many), "op3-branching"))[0]
        large = few(large.select("node", "tree", "used", "rep", n.alias("held")).join(signs, "rep"), many, SKETCHES)
    over = None if over is None else stored(few(over, found), "op3-over")
    return done, None if over is None or over.isEmpty() else _united(over, leaf)[0].withColumnRenamed("name", "node")


def _once(rows: DataFrame, many: int) -> DataFrame:
    """rows (node, rep), about `many`, without nodes that hold the very sets of another one, as trees often do: their pairs are the same."""
    held = few(rows.groupBy("node").agg(F.count("*").alias("n"), *[F.bit_xor(F.xxhash64("rep", F.lit(k))).alias(f"h{k}") for k in (0, 1)]), many)
    return few(rows.join(few(held.groupBy("n", "h0", "h1").agg(F.min("node").alias("node")), many).select("node"), "node", "left_semi"), many)


def _pieces(over: DataFrame, leaf: int) -> DataFrame:
    """(node, rep) of the nodes cut into pieces of about `leaf` sets, each a node of its own."""
    many = over.count()
    parts = few(over.groupBy("node").agg(F.ceil(F.count("*") / F.lit(leaf)).cast("long").alias("parts")), many)
    return few(over.join(parts, "node"), many).select(F.xxhash64("node", F.pmod(F.xxhash64("rep", F.lit(6)), F.col("parts")), F.lit(7)).alias("node"), "rep")


def _blocks(over: DataFrame, leaf: int) -> DataFrame:
    """(node, rep) for rows node, rep, comp, a table that is cheap to count: nodes in which all sets of different components meet. Sets of small components meet on
    lines. A component of more than leaf / 2 sets has blocks of that size, which meet those of others and do not meet each other."""
    half, many = max(1, leaf // 2), over.count()
    sizes = few(over.groupBy("node", "comp").agg(F.count("*").alias("m")), many)
    rest = few(sizes.where(F.col("m") <= half).groupBy("node").agg(F.sum("m").alias("mixed")), many)
    parts = lambda n: F.ceil(F.coalesce(n, F.lit(1)) / F.lit(half)).cast("long")
    own = F.when(F.col("m") > half, F.col("comp"))
    count = F.when(own.isNotNull(), parts(F.col("m"))).otherwise(parts(F.col("mixed")))
    kinds = few(sizes.join(rest, "node", "left"), many).select("node", "comp", own.alias("own"), count.alias("parts"))
    rows = few(over.join(kinds, ["node", "comp"]), many).select("node", "rep", "own", F.pmod(F.xxhash64("rep", F.lit(5)), F.col("parts")).alias("k"))
    rows = stored(rows.withColumn("block", F.xxhash64("own", "k")), "op3-blocks")
    blocks = few(rows.select("node", "block", "own").distinct(), many)
    p, q = [blocks.select("node", F.col("block").alias(x), F.col("own").alias(f"own_{x}")) for x in ("p", "q")]
    two = few(p.where("own_p IS NOT NULL").join(q, "node"), many).where("own_q IS NULL OR own_p < own_q")
    met = two.select("node", F.xxhash64("node", "p", "q").alias("meet"), F.explode(F.array("p", "q")).alias("block"))
    met = rows.join(met, ["node", "block"]).select(F.col("meet").alias("node"), "rep")
    return met.unionByName(_lines(rows.where("own IS NULL").select("node", "rep"), leaf))


def _compare(rows: DataFrame, reps: DataFrame, percent: int, everything: bool) -> DataFrame:
    """Likely pairs of rows (node, rep, comp), a table that is cheap to count: a, b of all of them, each once, or node, root, a, b of a spanning forest."""
    many = rows.count()
    sketch = reps.select("rep", "n_shingles", F.col("least" if everything else "low").alias("sketch"))
    sketch = suspects(sketch, "rep", stored(few(rows.select("rep").distinct(), many), "op3-compared"))[0]
    wide = few(rows.join(sketch, "rep"), many, SKETCHES).select("node", "rep", "comp", "n_shingles", "sketch")
    near = few(wide.repartition("node"), many, SKETCHES).sortWithinPartitions("node")
    if everything:
        return few(near.mapInArrow(_leaf_pairs(percent, True), "a long, b long").distinct(), many)
    return near.mapInArrow(_leaf_pairs(percent, False), "node long, root long, a long, b long")


def _connected(forest: DataFrame) -> DataFrame:
    """(node, rep): a node for the sets of each tree of a forest. A set without a likely pair is in none."""
    return forest.select(F.xxhash64("node", "root").alias("node"), F.explode(F.array("a", "b")).alias("rep")).distinct()


def _plausible(percent: int):
    """Of rows a, b, na, nb, la, lb those that are likely by their sizes and lowest tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*[batch.column(c).to_pylist() for c in ("a", "b", "na", "nb", "la", "lb")], strict=True)
            yield _pairs([(a, b) for a, b, na, nb, la, lb in rows if len(likely_by_least([unpacked(la), unpacked(lb)], np.array([na, nb]), percent)[0])])
        give_back()

    return run


def _with_sets(pairs: DataFrame, sets: DataFrame, of: str, other: str, to: str) -> DataFrame:
    """pairs, a table that is cheap to count, with the set of column `of` as `to`. A set with many pairs is sent to several tasks, each with a part of them."""
    many = pairs.count()
    hubs = few(pairs.groupBy(F.col(of).alias("hub")).agg(F.ceil(F.count("*") / HUB).cast("int").alias("parts")).where("parts > 1"), many)
    part = F.when(F.col("parts").isNotNull(), F.pmod(F.xxhash64(other), F.col("parts"))).otherwise(F.lit(0)).cast("int")
    dealt = few(pairs.join(hubs, pairs[of] == hubs["hub"], "left"), many).withColumn("part", part).drop("hub", "parts")
    copies = F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("part")
    sent = sets.join(hubs, sets["rep"] == hubs["hub"], "left").select(F.col("rep").alias(of), F.col("shingles").alias(to), copies)
    return few(dealt.join(sent, [of, "part"]), many, FULL).drop("part")


def _cells(pairs: DataFrame, sizes: DataFrame) -> DataFrame:
    """(cell, rep, others) for pairs a, b and sizes (rep, n_shingles): each pair is in one cell, as a rep and one of its others, and
    each set of a cell has one row there. Pairs go together by the least set that is linked with one of theirs; a cell holds the
    pairs of two blocks of such a group, which hold about CELL sets and CELL_SHINGLES at most. So a full set moves once a cell, not once a pair."""
    many = 2 * pairs.count()
    ends = pairs.select(F.col("a").alias("rep"), F.col("b").alias("other")).unionByName(pairs.select(F.col("b").alias("rep"), F.col("a").alias("other")))
    least = few(ends.groupBy("rep").agg(F.min("other").alias("other")), many).select("rep", F.least("rep", "other").alias("least"))
    of = lambda x: least.select(F.col("rep").alias(x), F.col("least").alias(f"least_{x}"))
    at = stored(few(few(pairs.join(of("a"), "a"), many).join(of("b"), "b"), many).select(F.least("least_a", "least_b").alias("root"), "a", "b"), "op3-linked")
    sets = few(few(at.select("root", F.explode(F.array("a", "b")).alias("rep")).distinct(), many).join(few(sizes.distinct(), many), "rep"), many)
    parts = few(sets.groupBy("root").agg(F.greatest(F.ceil(F.count("*") / F.lit(CELL)), F.ceil(F.sum("n_shingles") / F.lit(CELL_SHINGLES))).cast("long").alias("parts")), many)
    p, q = [F.pmod(F.xxhash64(x, F.lit(11)), F.col("parts")) for x in ("a", "b")]
    at = few(at.join(parts, "root"), many).select(F.xxhash64("root", F.least(p, q), F.greatest(p, q)).alias("cell"), "a", "b")
    both = at.select("cell", F.col("a").alias("rep"), F.col("b").alias("other")).unionByName(at.select("cell", F.col("b").alias("rep"), F.lit(None).cast("long").alias("other")))
    return stored(few(both.groupBy("cell", "rep").agg(F.collect_list("other").alias("others")), many), "op3-cells")


def _single(sets: DataFrame) -> DataFrame:
    """rows (rep, shingles), a table that is cheap to count, with one for each rep; only those that are repeated are shuffled for it."""
    many = sets.count()
    repeated = stored(few(sets.groupBy("rep").agg(F.count("*").alias("n")).where("n > 1").select("rep"), many), "op3-repeated-sets")
    if repeated.isEmpty():
        return sets
    some, others = suspects(sets, "rep", repeated)
    return others.unionByName(few(some.groupBy("rep").agg(F.any_value("shingles").alias("shingles")), many, FULL))


def _confirmed(pairs: DataFrame, docs: DataFrame, folded: DataFrame, percent: int, bits: int | None) -> DataFrame:
    """The pairs, each once in a table that is cheap to count, whose full shingle sets, taken from the texts again, reach the threshold."""
    spark, many = docs.sparkSession, 2 * pairs.count()
    named = few(pairs.select(F.col("a").alias("rep")).unionByName(pairs.select(F.col("b").alias("rep"))).distinct(), many)
    named = stored(few(folded.select("rep", "doc_id", "n_shingles").join(named, "rep", "left_semi"), many), "op3-named")
    keys = named.count()
    bits = bits or bits_for(keys)
    ids = marked(bitmap(named.select(slot([F.col("doc_id")], bits).alias("slot")), bits, keys), slot([F.col("doc_id")], bits))
    names = marked(bitmap(named.select(slot([F.col("rep")], bits).alias("slot")), bits, keys), slot([F.col("rep")], bits))
    with small_batches(spark, 1000):
        found = docs.where(F.col("doc_id").isNotNull() & ids).select("text").mapInArrow(_full_sets, "rep long, shingles binary").where(names)
        sets, own = kept_at(found, "op3-sets")
    cells = _cells(pairs, named.select("rep", "n_shingles"))
    met = _with_sets(cells, _single(sets), "rep", "cell", "shingles").select("cell", "rep", "others", "shingles")
    with small_batches(spark, 500):
        links = stored(few(met.repartition("cell"), cells.count(), FULL).sortWithinPartitions("cell").mapInArrow(_confirm(percent), "a long, b long"), "op3-links")
    drop(spark, own)
    return links


def _labels(links: DataFrame) -> DataFrame:
    return components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))


def _judged(docs: DataFrame, percent: int, trees: int, leaf: int, depth: int, bits: int | None) -> DataFrame:
    """doc_id, text_key, n_shingles, component_id, kept, set_size for rows doc_id, text, text_key."""
    spark = docs.sparkSession
    mark = scratch_mark()
    with small_batches(spark, 2000):
        wide, at = kept_at(docs.mapInArrow(_sketch, "doc_id long, text_key binary, n_shingles long, set_key binary, sig binary, low binary, least binary"), "op3-wide")
    has_set = "set_key IS NOT NULL AND doc_id IS NOT NULL"
    one = [F.any_value(c).alias(c) for c in ("n_shingles", "sig", "low", "least")]
    all_docs = wide.count()
    repeated = stored(few(wide.where(has_set).groupBy("set_key").agg(F.count("*").alias("n")).where("n > 1").select("set_key"), all_docs), "op3-repeated")
    some, others = suspects(wide.where(has_set), "set_key", repeated, bits)  # only sketches of sets that may repeat are shuffled
    folded = few(some.groupBy("set_key").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("set_size"), *one), all_docs, SKETCHES)
    folded = folded.unionByName(others.select("set_key", "doc_id", F.lit(1).cast("long").alias("set_size"), "n_shingles", "sig", "low", "least"))
    folded, folded_at = kept_at(folded.withColumn("rep", F.expr("conv(hex(substring(set_key, 1, 8)), 16, -10)").cast("long")), "op3-reps")
    reps = folded.select("rep", "n_shingles", "sig", "low", "least")
    sketch, sketch_at = kept_at(wide.drop("sig", "low", "least"), "op3-sketch")
    drop(spark, at)

    leaves, over = _leaves(reps, trees, leaf, depth, percent)
    leaves = stored(_once(leaves, leaves.count()), "op3-leaves")
    with small_batches(spark, 2000):
        forest = stored(_compare(leaves.withColumn("comp", F.col("rep")), reps, percent, False), "op3-forest")
    first = forest.select("a", "b")
    if over is not None:
        pieces = stored(_pieces(over, leaf), "op3-pieces")
        with small_batches(spark, 2000):
            first = first.unionByName(stored(_compare(pieces.withColumn("comp", F.col("rep")), reps, percent, False).select("a", "b"), "op3-forest2"))
        pivots = few(over.groupBy("node").agg(F.min("rep").alias("a")), over.count())
        first = first.unionByName(few(over.join(pivots, "node"), over.count()).where("rep > a").select("a", F.col("rep").alias("b")))
    first = stored(few(first.distinct(), forest.count() + (over.count() if over is not None else 0)), "op3-pairs")
    many = first.count()
    tokens = lambda x: suspects(reps, "rep", stored(few(first.select(x).distinct(), many), "op3-ends"), bits)[0].select(F.col("rep").alias(x), F.col("n_shingles").alias(f"n{x}"), F.col("least").alias(f"l{x}"))
    with small_batches(spark, 2000):
        some = few(few(first.join(tokens("a"), "a"), many, SKETCHES).join(tokens("b"), "b"), many, SKETCHES).select("a", "b", "na", "nb", "la", "lb")
        some = stored(some.mapInArrow(_plausible(percent), "a long, b long"), "op3-plausible")
    links = _confirmed(some, docs, folded, percent, bits)

    labels = stored(_labels(links), "op3-labels1")
    at = lambda rows, many: few(rows.join(labels, rows["rep"] == labels["node"], "left"), many).select(rows["node"], *[rows[c] for c in rows.columns if c != "node"], F.coalesce("root", "rep").alias("comp"))
    mixed = lambda rows, many: few(rows.join(few(rows.groupBy("node").agg((F.min("comp") < F.max("comp")).alias("mixed")).where("mixed"), many), "node"), many).drop("mixed")
    many = 2 * forest.count()
    again = mixed(at(few(_connected(forest), many), many), many)
    if over is not None:
        many = over.count()
        met = stored(_blocks(stored(mixed(at(over, many), many), "op3-mixed"), leaf), "op3-met")
        many = met.count()
        again = again.unionByName(mixed(at(met, many), many))
    again = stored(again.select("node", "rep", "comp"), "op3-again")
    with small_batches(spark, 2000):
        second = stored(few(_compare(stored(_once(again, again.count()), "op3-again-once"), reps, percent, True).join(first, ["a", "b"], "left_anti"), again.count()), "op3-pairs2")
    links2 = None if second.isEmpty() else _confirmed(second, docs, folded, percent, bits)

    roots = labels if links2 is None or links2.isEmpty() else _labels(labels.where("node <> root").select(F.col("root").alias("a"), F.col("node").alias("b")).unionByName(links2))
    named = few(folded.join(roots, folded["rep"] == roots["node"], "left"), all_docs).select("set_key", "set_size", "doc_id", F.coalesce("root", "rep").alias("root"))
    least = few(named.groupBy("root").agg(F.min("doc_id").alias("component_id")), all_docs)
    by_set, by_set_at = kept_at(few(named.join(least, "root"), all_docs).select("set_key", "set_size", "component_id"), "op3-sets-named")
    clear_scratch(spark, mark, {sketch_at, by_set_at})
    found = sketch.where(has_set).join(by_set, "set_key").select("doc_id", "text_key", "n_shingles", "component_id", "set_size")
    alone = sketch.where(f"NOT ({has_set})").select("doc_id", "text_key", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(1).cast("long").alias("set_size"))
    return found.unionByName(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85, trees: int = 16, leaf: int = 256, depth: int = 6, bitmap_bits: int | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, set_size (documents with the same shingle set) for every row
    of docs. Linked are documents whose shingle sets have 100 * intersection >= percent * union.

    trees: 1 to COORDS. bitmap_bits: size of the bitmaps that choose rows for a join; by default it follows the counts.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.lit(b"").alias("text_key"))
    return _judged(rows, percent, trees, leaf, depth, bitmap_bits).select("doc_id", "n_shingles", "component_id", "kept", "set_size")


def _text_key(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85) -> DataFrame:
    """docs with one document of each group of near duplicates, with its own columns. Rows leave by id and text."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), _text_key(F.col(text_col)).alias("text_key"))
    gone = stored(_judged(rows, percent, 16, 256, 6, None).where("NOT kept").select(F.col("doc_id").alias("__gone"), F.col("text_key").alias("__key")).distinct(), "op3-gone")
    some, others = suspects(docs, id_col, gone.select("__gone"))
    some = some.withColumn("__own", _text_key(F.col(text_col)))
    return others.unionByName(some.join(gone, (some[id_col] == gone["__gone"]) & (some["__own"] == gone["__key"]), "left_anti").drop("__own"))
