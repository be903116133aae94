"""N-gram Jaccard join by signature trees.

Two documents link when ``100 * |A & B| >= percent * |A | B|`` on their sets of
distinct word shingles. Steps, each a Spark job over whole tables:

1. One pass over the texts hashes every shingle set (numpy on Arrow buffers)
   into a digest, and counts tokens in counters of bounded number. Equal sets
   share a digest, so copies are one node from here on.
2. Routing is exact, by one of two rules. Sets that share a key are linked to the
   smallest of them; components of these links are the trees' families: every link
   lies within one family. Sizes are banded, a set taking part in the bands that
   the smaller set of a link may have, so that a long text connects no short ones.
   Pigeonhole: linked sets differ in at most D tokens; split the hash space into
   D + 1 + E segments and at least E + 1 segments agree. A set with at most E empty
   segments needs keys for non-empty ones only. A segment holds about
   ``percent / (100 - percent)`` tokens; from SEGMENT_TOKENS on this rule comes first,
   since few strangers agree on so many.
   Prefix filter, below that: linked sets share one of the first
   ``n - ceil(percent * n / 100) + 1`` tokens of either, in any one order of all
   tokens. Rarest come first, so a shared line or passage connects little: tokens
   are counted exactly, one shuffle of (token, set), but for those whose counter is
   far above the mean; these come last, so no token's rows grow into one task.
   Families of more than a block are routed anew by the tokens that are rare
   among their members, and by pigeonhole.
3. A family is cut into blocks of bounded size. A task bulk-loads a signature
   tree per block (leaves: token bitmap and size; nodes: OR of their children's
   bitmaps, and size ranges), traverses the tree against itself level by level,
   prunes node pairs whose greatest possible overlap is too small, and verifies
   surviving leaf pairs on the sets. Pairs already connected are skipped.
4. Families of several blocks go on with the roots of what their blocks have
   connected, re-blocked until one block holds them, then compare what is still
   apart: members outside a family's largest component against all its blocks.

Defined results: null and empty texts and texts without words have an empty
set, link with nothing and are their own component; ties and repeated rows of
equal text fall into one component; an empty table gives no rows; columns
other than ``doc_id`` and ``text`` are not read. Rows without an id link like any
other and never name a component that holds an id; rows of one id with several
texts are rows of their own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cinelake.llm.graph import components
from cinelake.llm.staging import release, ship_package, stage, unstage
from cinelake.llm.text import mix, set_digest, shingle_sets

BLOCK = 256
FANOUT = 4
BAND = 1.5
#: Counters that order tokens by how rare they are.
SLOTS = 1 << 18
SPARE = 64
#: Bits of a token's hash that are shuffled to count it, and the count that fits above.
TOKEN_BITS, MOST_COUNT = 48, (1 << 15) - 1
#: Routing keys that a task holds and links among themselves at a time.
HELD_KEYS = 1 << 18
#: Tokens of a segment from which on sets are routed by segments first.
SEGMENT_TOKENS = 8
#: How families of more than a block are routed anew, one way after the other.
REROUTE = ("rare", "segments")
SETS_SCHEMA = "doc_id long, n long, d1 long, d2 long, low int, high int, slot int, c long"
STARS_SCHEMA = "key long, v long, part long, u long"
SETS_NAMES = [c.split()[0] for c in SETS_SCHEMA.split(", ")]


# ---------------------------------------------------------------- routing


@lru_cache(maxsize=4096)
def _band_start(b: int) -> int:
    start = 1
    for _ in range(b):
        start = max(start + 1, int(start * BAND))
    return start


@lru_cache(maxsize=65536)
def _band_of(n: int) -> int:
    b = 0
    while _band_start(b + 1) <= n:
        b += 1
    return b


def bands(n: int, percent: int) -> range:
    """Bands of the sizes that the smaller set of a link may have, if a set of
    ``n`` tokens is one of the two: both are in the band of the smaller."""
    return range(_band_of(-(-percent * n // 100)), _band_of(n) + 1) if n else range(0)


@lru_cache(maxsize=4096)
def band_split(b: int, percent: int) -> tuple[int, int]:
    """(segments, empty segments allowed) for pairs whose smaller set is in band ``b``."""
    small = _band_start(b + 1) - 1
    apart = (small + small * 100 // percent) * (100 - percent) // (100 + percent)
    segments, spare = apart + 1, 0
    if apart:
        for _ in range(8):
            empty = segments * math.exp(-_band_start(b) / segments)
            spare = math.ceil(empty + 4 * math.sqrt(empty)) if empty > 1e-9 else 0
            spare = min(spare, apart + 2)
            segments = apart + 1 + spare
    return segments, spare


def routing_keys(tokens: np.ndarray, percent: int) -> np.ndarray:
    """Keys of a set: two sets that link share at least one."""
    n, out = len(tokens), []
    if not n:
        return np.empty(0, np.int64)
    for b in bands(n, percent):
        segments, spare = band_split(b, percent)
        where = (mix(tokens ^ np.uint64(0x452821E638D01377)) % np.uint64(segments)).astype(np.int64)
        sums = np.zeros(segments, np.uint64)
        np.add.at(sums, where, mix(tokens ^ np.uint64(0xBE5466CF34E90C6C)))
        filled = np.bincount(where, minlength=segments) > 0
        if segments - int(filled.sum()) > spare:
            filled[:] = True
        at = np.flatnonzero(filled)
        out.append(mix(sums[at] + mix(at.astype(np.uint64) + np.uint64((b + 1) << 32))))
    return np.concatenate(out).view(np.int64)


def _slot(tokens: np.ndarray) -> np.ndarray:
    return (mix(tokens ^ np.uint64(0x3C6EF372FE94F82B)) & np.uint64(SLOTS - 1)).astype(np.int64)


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1 if n else 0


def rare_tokens(tokens: np.ndarray, counts: np.ndarray, percent: int) -> np.ndarray:
    """The tokens of a set that a linked set may share first, rarest ones first."""
    return tokens[np.lexsort((tokens, counts[_slot(tokens)]))[: prefix_length(len(tokens), percent)]]


def _hash_sets(size: int, percent: int):
    """Rows of texts → a row per text (``slot`` null), and after them how many of
    the task's sets hold a token of each counter's slot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SLOTS, np.int64)
        for batch in batches:
            n, d1, d2, held, tokens_held = [], [], [], [], 0
            for tokens in shingle_sets(batch.column("text"), size):
                a, b = set_digest(tokens)
                n.append(len(tokens))
                d1.append(a)
                d2.append(b)
                held.append(tokens)
                tokens_held += len(tokens)
                if tokens_held > HELD_KEYS:
                    counts += np.bincount(_slot(np.concatenate(held)), minlength=SLOTS)
                    held, tokens_held = [], 0
            counts += np.bincount(_slot(np.concatenate([*held, np.empty(0, np.uint64)])), minlength=SLOTS)
            spans = [bands(k, percent) for k in n]
            low, high = (pa.array(c, pa.int32()) for c in ([r.start for r in spans], [r.stop - 1 for r in spans]))
            none = pa.nulls(len(n))
            columns = [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in (n, d1, d2)), low, high, none.cast(pa.int32()), none.cast(pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, SETS_NAMES)
        at = np.flatnonzero(counts)
        none, small = pa.nulls(len(at), pa.int64()), pa.nulls(len(at), pa.int32())
        yield pa.RecordBatch.from_arrays([none, none, none, none, small, small, pa.array(at, pa.int32()), pa.array(counts[at])], SETS_NAMES)

    return run


def _star_rows(keys: np.ndarray, nodes: np.ndarray, parts: np.ndarray) -> pa.RecordBatch:
    """(key, v, part, u): the smallest node of each key with ``u`` null, and links
    (v, u) of the others to it, under keys that spread them. A key occurs in one
    part only."""
    order = np.lexsort((nodes, keys))
    keys, nodes, parts = keys[order], nodes[order], parts[order]
    head = np.ones(len(keys), bool)
    head[1:] = keys[1:] != keys[:-1]
    least = nodes[head][np.cumsum(head) - 1] if len(keys) else nodes
    other = nodes != least
    links = np.unique(np.stack([nodes[other], least[other], parts[other]], axis=1), axis=0)
    v, u, part = (np.ascontiguousarray(links[:, c]) for c in range(3))
    spread = mix(v.view(np.uint64) ^ mix(u.view(np.uint64))).view(np.int64)
    columns = [np.concatenate(c) for c in ((keys[head], spread), (nodes[head], v), (parts[head], part))]
    last = pa.concat_arrays([pa.nulls(int(head.sum()), pa.int64()), pa.array(u)])
    return pa.RecordBatch.from_arrays([*(pa.array(c) for c in columns), last], ["key", "v", "part", "u"])


def _route(size: int, percent: int, keys_of, by: str):
    """Rows of texts → :func:`_star_rows` of bounded batches of sets. Keys meet
    within a part: by ``family``, nodes are the ``rep`` of rows and parts their
    families; else nodes are digests and parts the ``band`` of sizes, or all one
    where the keys tell bands apart. Equal sets of a batch give their keys once."""
    family = by == "family"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, nodes, parts, seen, held = [], [], [], set(), 0
        for batch in batches:
            given = zip(batch.column("family").to_pylist(), batch.column("rep").to_pylist(), strict=True) if family else None
            for tokens in shingle_sets(batch.column("text"), size):
                if family:
                    part, node = next(given)
                    within = [part]
                else:
                    node, other = set_digest(tokens)
                    if (node, other) in seen:
                        continue
                    seen.add((node, other))
                    within = bands(len(tokens), percent) if by == "band" else [0]
                own = keys_of(tokens).view(np.uint64)
                for part in within:
                    keys.append(mix(own + mix(np.array([part], np.int64).view(np.uint64))).view(np.int64))
                    nodes.append(np.full(len(own), node, np.int64))
                    parts.append(np.full(len(own), part, np.int64))
                    held += len(own)
                if held >= HELD_KEYS:
                    yield _star_rows(*(np.concatenate(c) for c in (keys, nodes, parts)))
                    keys, nodes, parts, seen, held = [], [], [], set(), 0
        none = np.empty(0, np.int64)
        yield _star_rows(*(np.concatenate([*c, none]) for c in (keys, nodes, parts)))

    return run


def _stars(found: DataFrame) -> DataFrame:
    """Distinct (u, v) that connect all (node, part) sharing a key, as their
    ``xxhash64``: one shuffle, in which a key has a row per batch of sets at most."""
    least = F.first("v").over(Window.partitionBy("key", F.col("u").isNull()).orderBy("v"))
    pairs = found.select(F.coalesce("u", least).alias("u"), "v", "part").where("u <> v")
    return pairs.select(F.xxhash64("u", "part").alias("u"), F.xxhash64("v", "part").alias("v")).distinct()


def _links(rows: DataFrame, size: int, percent: int, keys_of, by: str) -> DataFrame:
    return _stars(rows.mapInArrow(_route(size, percent, keys_of, by), STARS_SCHEMA))


def _plain_tokens(size: int, percent: int, shared, limit: int):
    """Rows of texts → (token, node, sizes) of the tokens that are to be counted,
    equal sets of a batch once; ``sizes`` holds n and ``room``. Of a set's tokens that
    others hold too, all but the ``room`` most frequent ones are keys. A token goes by
    TOKEN_BITS of its hash: those that meet are one token in every set, and a set has
    as many keys of them as it had of its own, so this links more and loses nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.frombuffer(shared.value, np.int64)
        for batch in batches:
            held, rows, seen = 0, [], set()
            for tokens in shingle_sets(batch.column("text"), size):
                digest = set_digest(tokens)
                if digest in seen:
                    continue
                seen.add(digest)
                plain = np.unique(tokens[counts[_slot(tokens)] <= limit] >> np.uint64(64 - TOKEN_BITS))
                n, m = len(tokens), len(plain)
                rows.append((plain, digest[0], n << 32 | max(0, m - prefix_length(n, percent))))
                held += m
                if held >= HELD_KEYS:
                    yield _token_rows(rows)
                    held, rows = 0, []
            yield _token_rows(rows)

    return run


def _token_rows(rows: list[tuple]) -> pa.RecordBatch:
    lengths = [len(r[0]) for r in rows]
    tokens = np.concatenate([*(r[0] for r in rows), np.empty(0, np.uint64)]).view(np.int64)
    rest = [np.repeat(np.array([r[k] for r in rows], np.int64), lengths) for k in (1, 2)]
    return pa.RecordBatch.from_arrays([pa.array(tokens), *(pa.array(c) for c in rest)], ["token", "node", "sizes"])


def _held_by_several(percent: int):
    """Rows in order of (token, node) → tokens of two nodes or more, with their
    count ``c`` of nodes and the bands of each node."""

    def found(cols: list[np.ndarray]) -> pa.RecordBatch:
        token, node, n, room = cols
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (node[1:] != node[:-1])
        token, node, n, room = (c[new] for c in cols)
        starts = np.flatnonzero(np.concatenate([np.ones(min(1, len(token)), bool), token[1:] != token[:-1]]))
        sizes = np.diff(np.append(starts, len(token)))
        c = np.repeat(sizes, sizes)
        keep = c > 1
        token, node, n, room, c = (x[keep] for x in (token, node, n, room, c))
        kinds, at = np.unique(n, return_inverse=True)
        spans = [bands(k, percent) for k in kinds.tolist()]
        low, high = (np.array(x, np.int64)[at] for x in ([r.start for r in spans], [r.stop - 1 for r in spans]))
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (token, node, room, c, low, high)], ["token", "node", "room", "c", "low", "high"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64)] * 4
        for batch in batches:
            held = [np.concatenate([h, batch.column(k).to_numpy()]) for k, h in enumerate(held)]
            if len(held[0]):
                cut = int(np.searchsorted(held[0], held[0][-1]))  # the last token may go on
                if cut:
                    yield found([h[:cut] for h in held])
                    held = [h[cut:] for h in held]
        yield found(held)

    return run


def _prefix_links(docs: DataFrame, size: int, percent: int, counts: np.ndarray) -> DataFrame:
    """:func:`_stars` of all sets by the prefix filter, tokens ordered by how many
    sets hold them. Counters above twice their mean (and SPARE) hold the tokens that
    come last; a token below has no more rows than that."""
    limit = 2 * int(counts.sum()) // SLOTS + SPARE
    shared = docs.sparkSession.sparkContext.broadcast(counts.tobytes())

    def last_ones(tokens: np.ndarray) -> np.ndarray:
        of = np.frombuffer(shared.value, np.int64)
        first = rare_tokens(tokens, of, percent)
        return first[of[_slot(first)] > limit].view(np.int64)

    rows = docs.mapInArrow(_plain_tokens(size, percent, shared, limit), "token long, node long, sizes long")
    rows = rows.repartition("token").sortWithinPartitions("token", "node")
    rows = rows.select("token", "node", F.expr("sizes >> 32").alias("n"), F.expr("sizes & 4294967295").alias("room"))
    several = rows.mapInArrow(_held_by_several(percent), "token long, node long, room long, c long, low long, high long")
    # Three numbers a row go through the second shuffle: the token below its count, the
    # node, and the node's room and bands. Counts from MOST_COUNT on rank alike.
    rank = F.expr(f"least(c, {MOST_COUNT}) << {TOKEN_BITS} | token").alias("rank")
    packed = several.select(rank, F.col("node").alias("v"), F.expr("room << 16 | low << 8 | high").alias("sizes"))
    turn = F.row_number().over(Window.partitionBy("v").orderBy(F.desc("rank")))
    kept = packed.withColumn("turn", turn).where("turn > sizes >> 16")
    kept = kept.select("rank", "v", F.explode(F.expr("sequence(sizes >> 8 & 255, sizes & 255)")).alias("part"))
    kept = kept.select(F.xxhash64("rank", "part").alias("key"), "v", "part", F.lit(None).cast("long").alias("u"))
    return _stars(kept.unionByName(docs.mapInArrow(_route(size, percent, last_ones, "band"), STARS_SCHEMA)))


def _rare_of(spark, counts: np.ndarray, percent: int):
    shared = spark.sparkContext.broadcast(counts.tobytes())

    def keys_of(tokens: np.ndarray) -> np.ndarray:
        return rare_tokens(tokens, np.frombuffer(shared.value, np.int64), percent).view(np.int64)

    return keys_of


def _segments_of(percent: int):
    return lambda tokens: routing_keys(tokens, percent)


def _counted(members: DataFrame, name: str) -> DataFrame:
    """Staged (rep, family, members) of families of two members or more."""
    many = members.groupBy("family").agg(F.count("*").alias("members")).where("members > 1")
    return stage(members.join(many, "family").select("rep", "family", "members"), name)


def _refined(members: DataFrame, texts: DataFrame, size: int, percent: int, by: str) -> DataFrame:
    """Staged (rep, family, members): families of more than a block split by keys
    that members share; members that share none are left out, they link with
    nothing. Rarity is counted over these members only, which tells rare tokens
    apart that the counters of all documents mixed."""
    spark = texts.sparkSession
    held = texts.join(members.select("rep", "family"), "rep")
    if by == "rare":
        counted = held.select(F.col("rep").alias("doc_id"), "text").mapInArrow(_hash_sets(size, percent), SETS_SCHEMA)
        keys_of = _rare_of(spark, _counters(counted), percent)
    else:
        keys_of = _segments_of(percent)
    edges = stage(_links(held, size, percent, keys_of, "family"), "family_links")
    split = components(edges)
    out = members.withColumn("node", F.xxhash64("rep", "family")).join(split, "node")
    out = _counted(out.select("rep", F.xxhash64("family", "root").alias("family")), "refined")
    unstage(edges, split)
    return out


# ---------------------------------------------------------------- trees


class _Forest:
    """Union-find over positions."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, a: int) -> int:
        up = self.up
        while up[a] != a:
            up[a] = up[up[a]]
            a = up[a]
        return a

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


class SignatureTree:
    """Bulk-loaded over sets ordered by size and smallest token.

    ``levels[0]`` are leaves. A level holds, per node, the OR of token bitmaps,
    the smallest and largest set size, and ``room``: the most by which a set's
    size exceeds its bitmap's bits (tokens that share a bit).
    """

    def __init__(self, sets: list[np.ndarray], bits: int):
        order = sorted(range(len(sets)), key=lambda i: (len(sets[i]), int(sets[i][0])))
        self.order, self.sets = order, sets
        maps = np.zeros((len(sets), bits // 64), np.uint64)
        for row, i in enumerate(order):
            at = sets[i] & np.uint64(bits - 1)
            np.bitwise_or.at(maps[row], (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
        size = np.array([len(sets[i]) for i in order], np.int64)
        room = size - np.bitwise_count(maps).sum(axis=1, dtype=np.int64)
        self.levels = [(maps, size, size, room)]
        while len(self.levels[-1][1]) > 1:
            m, lo, hi, r = self.levels[-1]
            cut = np.arange(0, len(lo), FANOUT)
            self.levels.append((np.bitwise_or.reduceat(m, cut, axis=0), np.minimum.reduceat(lo, cut), np.maximum.reduceat(hi, cut), np.maximum.reduceat(r, cut)))


def bitmap_bits(sets: list[np.ndarray]) -> int:
    most = max((len(s) for s in sets), default=1)
    return 1 << min(18, max(8, (16 * most - 1).bit_length()))


def _possible(x: tuple, y: tuple, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Which node pairs may hold a link, by size range and greatest overlap."""
    ok = np.ones(len(a), bool)
    for at in range(0, len(a), 4096):
        p, q = a[at : at + 4096], b[at : at + 4096]
        shared = np.bitwise_count(x[0][p] & y[0][q]).sum(axis=1, dtype=np.int64)
        most = np.minimum(np.minimum(x[3][p], y[3][q]) + shared, np.minimum(x[2][p], y[2][q]))
        least = x[1][p] + y[1][q]
        near = (100 * x[2][p] >= percent * y[1][q]) & (100 * y[2][q] >= percent * x[1][p])
        ok[at : at + 4096] = near & ((100 + percent) * most >= percent * least)
    return ok


def traverse(x: SignatureTree, y: SignatureTree, percent: int) -> Iterator[tuple[int, int]]:
    """Leaf pairs (positions in ``x.sets`` and ``y.sets``) that survive pruning;
    with ``x is y`` each unordered pair of two leaves once."""
    same = x is y
    i, j = len(x.levels) - 1, len(y.levels) - 1
    a, b = np.zeros(1, np.int64), np.zeros(1, np.int64)

    def children(parents: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
        kids = parents[:, None] * FANOUT + np.arange(FANOUT)
        return kids, kids < count

    while len(a):
        keep = _possible(x.levels[i], y.levels[j], a, b, percent)
        a, b = a[keep], b[keep]
        if i == j == 0:
            break
        ka, fa = children(a, len(x.levels[i - 1][1])) if i else (a[:, None], np.ones((len(a), 1), bool))
        kb, fb = children(b, len(y.levels[j - 1][1])) if j else (b[:, None], np.ones((len(b), 1), bool))
        pa_, pb_ = np.broadcast_arrays(ka[:, :, None], kb[:, None, :])
        ok = fa[:, :, None] & fb[:, None, :]
        i, j = max(0, i - 1), max(0, j - 1)
        if same:
            ok = ok & ((pa_ < pb_) if i == 0 else (pa_ <= pb_))
        a, b = pa_[ok], pb_[ok]
    for p, q in zip(a.tolist(), b.tolist(), strict=True):
        yield x.order[p], y.order[q]


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def block_roots(sets: list[np.ndarray], percent: int, forest: _Forest | None = None) -> _Forest:
    """Connect the sets of one block."""
    forest = forest or _Forest(len(sets))
    if len(sets) > 1:
        tree = SignatureTree(sets, bitmap_bits(sets))
        for a, b in traverse(tree, tree, percent):
            if forest.find(a) != forest.find(b) and linked(sets[a], sets[b], percent):
                forest.join(a, b)
    return forest


# ---------------------------------------------------------------- jobs over blocks


def _runs(batches: Iterator[pa.RecordBatch], size: int, keys: list[str], carried: list[str]) -> Iterator[list[tuple]]:
    """Consecutive rows of one block: (carried..., set). Blocks are bounded by
    construction, so one block is held at a time."""
    held, key = [], None
    for batch in batches:
        cols = [batch.column(c).to_pylist() for c in keys]
        rest = [batch.column(c).to_pylist() for c in carried]
        for row, tokens in enumerate(shingle_sets(batch.column("text"), size)):
            now = tuple(c[row] for c in cols)
            if now != key and held:
                yield held
                held = []
            key = now
            held.append((*(c[row] for c in rest), tokens))
    if held:
        yield held


def _join_blocks(size: int, percent: int):
    """Rows of (family, block) runs → (family, rep, root), root a smallest rep."""

    def run(batches):
        family, rep, root = [], [], []

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (family, rep, root)], ["family", "rep", "root"])
            for c in (family, rep, root):
                c.clear()
            return out

        for rows in _runs(batches, size, ["family", "block"], ["rep", "family"]):
            rows.sort(key=lambda r: r[0])
            forest = block_roots([r[2] for r in rows], percent)
            for i, r in enumerate(rows):
                family.append(r[1])
                rep.append(r[0])
                root.append(rows[forest.find(i)][0])
            if len(rep) >= 20_000:
                yield flush()
        yield flush()

    return run


def _probe_blocks(size: int, percent: int):
    """Runs of one block and one block of probes → links (u, v) between members
    whose components differ."""

    def run(batches):
        for rows in _runs(batches, size, ["family", "block", "probes"], ["probe", "rep", "root"]):
            asked = [r for r in rows if r[0]]
            there = [r for r in rows if not r[0]]
            if not asked or not there:
                continue
            bits = bitmap_bits([r[3] for r in rows])
            x, y = SignatureTree([r[3] for r in asked], bits), SignatureTree([r[3] for r in there], bits)
            ids: dict[int, int] = {}
            for r in rows:
                ids.setdefault(r[2], len(ids))
            forest, u, v = _Forest(len(ids)), [], []
            for a, b in traverse(x, y, percent):
                p, q = asked[a], there[b]
                if forest.find(ids[p[2]]) != forest.find(ids[q[2]]) and linked(p[3], q[3], percent):
                    forest.join(ids[p[2]], ids[q[2]])
                    u.append(p[2])
                    v.append(q[2])
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    return run


def _in_order(df: DataFrame, *keys: str) -> DataFrame:
    return df.repartition(*keys).sortWithinPartitions(*keys)


def _blocked(df: DataFrame, count: str = "members") -> DataFrame:
    """Blocks of about BLOCK members of a family, by a hash of the member."""
    return df.withColumn("block", F.pmod(F.xxhash64("rep"), F.ceil(F.col(count) / BLOCK)).cast("long"))


def _with_text(members: DataFrame, texts: DataFrame) -> DataFrame:
    """A sort-merge join at every size: members grow with the input, so they are
    never broadcast."""
    return members.hint("merge").join(texts, "rep")


def _joined(rows: DataFrame, size: int, percent: int) -> DataFrame:
    return _in_order(rows, "family", "block").mapInArrow(_join_blocks(size, percent), "family long, rep long, root long")


def _large_families(roots: DataFrame, members: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """(rep, root) of families of several blocks, from their blocks' roots.

    ``roots``: staged (family, rep, root) of all members of such families.
    """
    texts = stage(_with_text(members, texts).select("family", "rep", "text"), "family_texts")
    links = [roots.select(F.col("rep").alias("u"), F.col("root").alias("v")).where("u <> v")]
    staged, tops = [], roots.select("family", F.col("root").alias("rep")).distinct()
    while True:
        counted = stage(tops.join(tops.groupBy("family").agg(F.count("*").alias("members")), "family").where("members > 1"), "family_roots")
        many = counted.agg(F.max("members"), F.count("*")).first()
        staged.append(counted)
        if not many[1]:
            break
        joined = stage(_joined(_blocked(counted).join(texts, ["family", "rep"]), size, percent), "root_links")
        staged.append(joined)
        links.append(joined.select(F.col("rep").alias("u"), F.col("root").alias("v")).where("u <> v"))
        tops = joined.select("family", F.col("root").alias("rep")).distinct()
        if many[0] <= BLOCK or tops.count() == many[1]:
            break
    edges = links[0]
    for more in links[1:]:
        edges = edges.unionByName(more)
    first = components(edges)
    now = members.select("family", "rep", "members").join(first.select(F.col("node").alias("rep"), "root"), "rep", "left")
    now = stage(now.withColumn("root", F.coalesce("root", "rep")), "family_now")

    release(members.sparkSession)

    # What is still apart: all but each family's largest component, against all blocks.
    sizes = now.groupBy("family", "root").agg(F.count("*").alias("c"))
    top = sizes.groupBy("family").agg(F.max_by("root", F.struct("c", "root")).alias("top"), F.count("*").alias("parts")).where("parts > 1")
    apart = now.join(top, "family")
    asked = apart.where("root <> top")
    counts = asked.groupBy("family").agg(F.ceil(F.count("*") / BLOCK).alias("groups"))
    blocks = F.ceil(F.col("members") / BLOCK)
    probes = asked.join(counts, "family").select(
        "family", "rep", "root", F.lit(True).alias("probe"),
        F.pmod(F.xxhash64("rep"), F.col("groups")).cast("long").alias("probes"),
        F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("block"),
    )
    there = _blocked(apart.join(counts, "family")).select(
        "family", "rep", "root", F.lit(False).alias("probe"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)).alias("probes"), "block",
    )
    rows = probes.unionByName(there).join(texts, ["family", "rep"])
    more = stage(_in_order(rows, "family", "block", "probes").mapInArrow(_probe_blocks(size, percent), "u long, v long"), "probe_links")
    second = components(more)
    out = stage(
        now.join(second.select(F.col("node").alias("root"), F.col("root").alias("over")), "root", "left").select("rep", F.coalesce("over", "root").alias("root")),
        "family_roots",
    )
    unstage(texts, *staged, first, now, more, second)
    return out


def _counters(sets: DataFrame) -> np.ndarray:
    counts = np.zeros(SLOTS, np.int64)
    found = sets.where("slot is not null").groupBy("slot").agg(F.sum("c").alias("c")).toArrow()  # at most SLOTS rows
    counts[found["slot"].to_numpy()] = found["c"].to_numpy()
    return counts


def _rows_of_their_own(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """:func:`jaccard_components` where ids are null or repeated: rows are numbered,
    and a component is named by the smallest id that it holds."""
    rows = stage(docs.withColumn("row", F.monotonically_increasing_id()), "numbered")
    found = jaccard_components(rows.select(F.col("row").alias("doc_id"), "text"), size, percent)
    found = found.select(F.col("doc_id").alias("row"), "n_shingles", F.col("component_id").alias("root"))
    named = stage(found.join(rows.select("row", "doc_id"), "row"), "numbered_roots")
    least = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    unstage(rows)
    return named.join(least, "root").select("doc_id", "n_shingles", "component_id")


def jaccard_components(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` per row of ``docs`` (columns ``doc_id``, ``text``).

    ``component_id`` is the smallest ``doc_id`` reachable over links, the row
    itself included; null where no row of the component has an id.
    """
    ship_package(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    spark = docs.sparkSession
    hashed = stage(docs.mapInArrow(_hash_sets(size, percent), SETS_SCHEMA), "sets")
    sets = hashed.where("slot is null").select("doc_id", "n", "d1", "d2", "low", "high")
    if not sets.groupBy("doc_id").count().where("doc_id is null or count > 1").isEmpty():
        unstage(hashed)
        return _rows_of_their_own(docs, size, percent)

    by_segments = percent >= SEGMENT_TOKENS * (100 - percent)
    if by_segments:
        links = _links(docs, size, percent, _segments_of(percent), "all")
    else:
        links = _prefix_links(docs, size, percent, _counters(hashed))
    chains = stage(links, "chains")
    release(spark)
    families = components(chains)
    unstage(chains)

    nodes = sets.where("n > 0").groupBy("d1", "d2", "n", "low", "high").agg(F.min("doc_id").alias("rep"))
    parts = F.array(F.lit(0).cast("long")) if by_segments else F.sequence(F.col("low").cast("long"), F.col("high").cast("long"))
    banded = nodes.select("rep", "d1", F.explode(parts).alias("part"))
    banded = banded.select("rep", F.xxhash64("d1", "part").alias("node"))
    member = _counted(banded.join(families, "node").select("rep", F.col("root").alias("family")), "members")
    release(spark)

    # One shuffle of all texts finds those of members; what follows reads these only.
    texts = stage(_with_text(member.select("rep").distinct(), docs.select(F.col("doc_id").alias("rep"), "text")), "member_texts")
    release(spark)

    # Each routing works on what the last left large.
    for by in REROUTE:
        large = member.where(F.col("members") > BLOCK)
        if by_segments and by == "segments":  # the same keys once more
            continue
        if large.isEmpty():
            break
        refined = _refined(large, texts, size, percent, by)
        whole = member.where(F.col("members") <= BLOCK).select("rep", "family", "members")
        routed = stage(whole.unionByName(refined), "routed")
        unstage(member, refined)
        member = routed
        release(spark)

    small = member.where(F.col("members") <= BLOCK).withColumn("block", F.lit(0).cast("long"))
    rows = small.unionByName(_blocked(member.where(F.col("members") > BLOCK)))
    roots = stage(_joined(_with_text(rows, texts).select("family", "block", "rep", "text"), size, percent), "block_roots")
    release(spark)

    # A set may be in a family of each of its bands: what they connect is one graph.
    edges = roots.select(F.col("rep").alias("u"), F.col("root").alias("v"))
    large = member.where(F.col("members") > BLOCK)
    if not large.isEmpty():
        of_large = stage(roots.join(large.select("family").distinct(), "family", "left_semi"), "large_roots")
        edges = edges.unionByName(_large_families(of_large, large, texts, size, percent).select(F.col("rep").alias("u"), F.col("root").alias("v")))
    unstage(texts)
    release(spark)
    found = components(edges).select(F.col("node").alias("rep"), "root")
    per_set = nodes.join(found, "rep", "left").select("d1", "d2", "n", F.coalesce("root", "rep").alias("component_id"))
    of_docs = sets.select("doc_id", "n", "d1", "d2")
    return of_docs.join(per_set, ["d1", "d2", "n"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )
