"""The trie of all conversations' prefixes, families first.

A conversation's family is all those of its base id. Each family is rebuilt and made a small trie by itself, and only what its
conversations have in common leaves it as one node; nodes of different families meet by a hash of the whole prefix: the sum of a hash
of each turn and its place, so that a long conversation's prefixes can be worked out in runs that know the sums before them.

What lies below a node is summed up without walking the levels: every node belongs to its smallest member, whose nodes are the end of
its path. Once each conversation knows from which depth on the nodes are its own, it gives its part to every node on its path, again
family by family. Nodes with one member need no second pass, as nothing is saved below them and there is one leaf.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from lexloom.llm.store import keep
from lexloom.llm.textcore import mix

#: Conversations of one family, and the most turns that one takes over from the base.
FAMILY, SHARED = 100, 5
#: Turns of one conversation that are worked on at once (more than SHARED): a group has so many for each member of the family at most.
RUN = 4096
#: Characters of a text that order turns of one place before its digest does.
HEAD = 48

_NODE = "base long, k1 long, k2 long, p1 long, p2 long, depth long, chars long, first long, n long, weight long"
_RUNS = "base long, run long, conv long, s1 long, s2 long, chars long, turns long"
_SUMS = "base long, run long, kind long, conv long, d1 long, d2 long, chars long, total long, length long"
_BELOW = "base long, k1 long, k2 long, chars long, leaves long, conv long"
_SALTS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], dtype=np.uint64)


def _long(h: Column) -> Column:
    """The 64 bits of 16 hex digits as a signed number."""
    return F.conv(h, 16, -10).cast("long")


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(base, conv, pos, run, d1, d2, chars): turns by their place in the conversation, from 0; digests stand for role and text.

    Turns are spread over tasks by range, so that a long conversation has many; each task numbers its own, and the few conversations
    that go on from one task to the next get an offset there. There are fewer of these than tasks.
    """
    c = F.col("conv_id").cast("long")
    role, text = (F.coalesce(F.col(x).cast("string"), F.lit("")) for x in ("role", "text"))
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    rows = conversations.where("conv_id is not null").select((c - c % FAMILY).alias("base"), c.alias("conv"), F.col("turn").cast("long").alias("turn"), role.alias("role"), F.left(text, F.lit(HEAD)).alias("head"), _long(F.substring(digest, 1, 16)).alias("d1"), _long(F.substring(digest, 17, 16)).alias("d2"), F.length(text).cast("long").alias("chars"))
    order = [F.col("base"), F.col("conv"), F.asc_nulls_first("turn"), F.col("role"), F.col("head"), F.col("d1"), F.col("d2")]
    # Equal rows may be many: their place in the input, which doesn't change what they are, lets them go to several tasks.
    dealt = rows.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(*order, F.col("row")).sortWithinPartitions(*order)

    def number(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, count = TaskContext.get().partitionId(), None, 0
        for frame in frames:
            own = frame.column("conv").to_numpy()
            if not len(own):
                continue
            new = np.r_[True, own[1:] != own[:-1]]
            start = np.flatnonzero(new)
            place = np.arange(len(own)) - np.repeat(start, np.diff(np.r_[start, len(own)]))
            if own[0] == last:
                place[: start[1] if len(start) > 1 else len(own)] += count
            last, count = own[-1], int(place[-1]) + 1
            yield pa.RecordBatch.from_arrays([*(frame.column(x) for x in ("base", "conv", "d1", "d2", "chars")), pa.array(place), pa.array(np.full(len(own), part, dtype=np.int64))], names=["base", "conv", "d1", "d2", "chars", "local", "part"])

    turns = keep(dealt.select("base", "conv", "d1", "d2", "chars").mapInArrow(number, "base long, conv long, d1 long, d2 long, chars long, local long, part long"), "turns")
    parts = turns.groupBy("conv", "part").agg(F.count("*").alias("n"))
    several = parts.groupBy("conv").agg(F.count("*").alias("parts"), F.sort_array(F.collect_list(F.struct("part", "n"))).alias("each")).where("parts > 1")
    offset = several.select("conv", F.posexplode("each").alias("i", "e"), "each").select(F.col("conv").alias("_c"), F.col("e.part").alias("_p"), F.aggregate(F.slice("each", F.lit(1), F.col("i")), F.lit(0).cast("long"), lambda s, x: s + x["n"]).alias("_offset"))
    out = turns.join(F.broadcast(offset), (F.col("conv") == F.col("_c")) & (F.col("part") == F.col("_p")), "left")  # fewer rows than two for each task
    pos = F.col("local") + F.coalesce("_offset", F.lit(0))
    return out.select("base", "conv", pos.alias("pos"), F.floor(pos / RUN).cast("long").alias("run"), "d1", "d2", "chars")


def _wanted(conv: np.ndarray) -> np.ndarray:
    """How many turns each conversation takes from its base."""
    return np.array([zlib.crc32(str(c).encode()) % (SHARED + 1) for c in conv.tolist()], dtype=np.int64)


def _place_hash(depth: np.ndarray, d1: np.ndarray, d2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of a turn at a depth; sums of them, modulo 2**64, stand for prefixes."""
    at = depth.astype(np.uint64)
    a, b = d1.view(np.uint64), d2.view(np.uint64)
    return tuple(mix(mix(x + at * salt) ^ mix(y ^ (at + salt))) for x, y, salt in ((a, b, _SALTS[0]), (b, a, _SALTS[1])))


def rebuilt(turns: pa.Table, heads: pa.Table, run: int) -> dict[str, np.ndarray]:
    """conv, depth (from 1), d1, d2, chars of a family's rebuilt conversations in one run, by conv and depth.

    heads: the base's first turns (pos, d1, d2, chars). Turns that are taken over belong to the first run.
    """
    col = {x: turns.column(x).to_numpy() for x in ("conv", "pos", "d1", "d2", "chars")}
    order = np.argsort(heads.column("pos").to_numpy(), kind="stable")
    head = {x: heads.column(x).to_numpy()[order] for x in ("d1", "d2", "chars")}
    ids, of = np.unique(col["conv"], return_inverse=True)
    h = _wanted(ids)
    taken = np.minimum(h, len(order))
    own = col["pos"] >= h[of]
    out = {"conv": col["conv"][own], "depth": (col["pos"] - h[of] + taken[of])[own] + 1} | {x: col[x][own] for x in head}
    if run == 0:
        each = np.repeat(np.arange(len(ids)), taken)
        at = np.arange(len(each)) - np.repeat(np.cumsum(taken) - taken, taken)
        out = {"conv": np.r_[out["conv"], ids[each]], "depth": np.r_[out["depth"], at + 1]} | {x: np.r_[out[x], head[x][at]] for x in head}
    by = np.lexsort((out["depth"], out["conv"]))
    return {x: v[by] for x, v in out.items()} | {"ids": ids}


def _groups(sorted_: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.r_[True, sorted_[1:] != sorted_[:-1]]) if len(sorted_) else np.zeros(0, dtype=np.int64)


def _running(values: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Running sums that begin anew at each start."""
    total = np.cumsum(values, dtype=values.dtype)
    before = np.r_[np.zeros(1, values.dtype), total][start]
    return total - np.repeat(before, np.diff(np.r_[start, len(values)]))


def _paths(turns: pa.Table, heads: pa.Table, before: pa.Table, run: int) -> dict[str, np.ndarray]:
    """rebuilt() with the key of each prefix and its parent's (k1, k2, p1, p2), the characters before a turn (past), and each conversation's
    sum of characters (total) in all its runs. before: (conv, d1, d2, chars, total, length) of long conversations."""
    p = rebuilt(turns, heads, run)
    start = _groups(p["conv"])
    size = np.diff(np.r_[start, len(p["conv"])])
    hashes = _place_hash(p["depth"], p["d1"], p["d2"])
    sums = [_running(x, start) for x in hashes]
    past = _running(p["chars"], start) - p["chars"]
    total, length = np.zeros(len(size), np.int64), size.astype(np.int64)
    if len(start):
        last = start + size - 1
        total = past[last] + p["chars"][last]
    if before.num_rows and len(start):
        col = {x: before.column(x).to_numpy() for x in ("conv", "d1", "d2", "chars", "total", "length")}
        known = dict(zip(col["conv"].tolist(), range(len(col["conv"])), strict=True))
        for i, c in enumerate(p["conv"][start].tolist()):
            if (k := known.get(c)) is not None:
                own = slice(start[i], start[i] + size[i])
                for s, x in zip(sums, ("d1", "d2"), strict=True):
                    s[own] += col[x].view(np.uint64)[k]
                past[own] += col["chars"][k]
                total[i], length[i] = col["total"][k], col["length"][k]
    parents = [s - x for s, x in zip(sums, hashes, strict=True)]
    return p | {"start": start, "past": past, "total": np.repeat(total, size), "end": p["depth"] == np.repeat(length, size)} | dict(zip(("k1", "k2", "p1", "p2"), (x.view(np.int64) for x in (*sums, *parents)), strict=True))


def _with_root(p: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Paths of a first run with the root as depth 0 of every conversation, also of those without turns."""
    ids, none = p["ids"], np.zeros(len(p["ids"]), np.int64)
    at = np.searchsorted(p["conv"][p["start"]], ids)
    has = np.isin(ids, p["conv"])
    total = none.copy()
    total[has] = p["total"][p["start"]][at[has]]
    root = {"conv": ids, "total": total, "end": ~has} | dict.fromkeys(("depth", "chars", "past", "k1", "k2", "p1", "p2"), none)
    return {x: np.r_[v, p[x]] for x, v in root.items()}


def _combined(p: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(order, start): rows of the same node together, by conv, and where each node's begin."""
    order = np.lexsort((p["conv"], p["k2"], p["k1"], p["depth"]))
    new = np.ones(len(order), dtype=bool)
    if len(order):
        new[1:] = False
    for x in ("depth", "k1", "k2"):
        v = p[x][order]
        new[1:] |= v[1:] != v[:-1]
    return order, np.flatnonzero(new)


def family_nodes(base: int, p: dict[str, np.ndarray], _: pa.Table) -> pa.Table:
    """The family's trie: a row a node with its smallest member, how many members it has, and weight: characters from this turn on, summed
    over its members."""
    order, start = _combined(p)
    if not len(order):
        return _empty(_NODE)
    top = order[start]
    return pa.table({"base": np.full(len(start), base), **{x: p[x][top] for x in ("k1", "k2", "p1", "p2", "depth", "chars")}, "first": p["conv"][top], "n": np.diff(np.r_[start, len(order)]), "weight": np.add.reduceat((p["total"] - p["past"])[order], start)})


def below(base: int, p: dict[str, np.ndarray], side: pa.Table) -> pa.Table:
    """What a family gives to its shared nodes: the characters of its conversations' own nodes in the subtree, and their leaves; and, with a
    conv, the nodes at which its conversations end."""
    fact = side.sort_by("conv")
    known = fact.column("conv").to_numpy()
    at = np.searchsorted(known, p["conv"])
    has = np.isin(p["conv"], known)
    far = np.iinfo(np.int64).max

    def value(name: str, none: int) -> np.ndarray:
        out = np.full(len(has), none, dtype=np.int64)
        out[has] = fact.column(name).to_numpy()[at[has]]
        return out

    o, s, leaf, mine = value("o", far), value("s", far), value("leaf", 0), value("mine", 0)
    own = np.where(p["depth"] >= o, p["total"] - p["past"], mine)
    shared = p["depth"] <= s
    rows = {x: p[x][shared] for x in ("conv", "k1", "k2", "depth")}
    order, start = _combined(rows)
    sums = _empty(_BELOW)
    if len(order):
        top = order[start]
        sums = pa.table({"base": np.full(len(start), base), "k1": rows["k1"][top], "k2": rows["k2"][top], "chars": np.add.reduceat(own[shared][order], start), "leaves": np.add.reduceat(leaf[shared][order], start), "conv": pa.nulls(len(start), pa.int64())})
    ends = {x: p[x][p["end"]] for x in ("k1", "k2", "conv")}
    none = np.zeros(len(ends["conv"]), np.int64)
    return pa.concat_tables([sums, pa.table({"base": none + base, "k1": ends["k1"], "k2": ends["k2"], "chars": none, "leaves": none, "conv": ends["conv"]})])


def _keys(key: tuple) -> tuple[int, int]:
    return tuple(int(k.as_py()) for k in key)


class Families:
    """The turns by family and run, with what each group needs from elsewhere: the base's first turns (kind 0), and sums before the run of
    conversations that have several (kind 1)."""

    def __init__(self, turns: DataFrame) -> None:
        self.turns = turns
        self.heads = turns.where((F.col("conv") == F.col("base")) & (F.col("pos") < SHARED)).select("base", F.lit(0).cast("long").alias("kind"), F.col("pos").alias("conv"), "d1", "d2", "chars")
        self.before = self._sums_before()

    def _cogroup(self, turns: DataFrame, f, schema: str, *more: DataFrame) -> DataFrame:
        side = turns.select("base", "run").distinct().join(self.heads, "base")
        for m in more:
            side = side.unionByName(m, allowMissingColumns=True)
        side = side.select(*(F.col(c).alias(c) for c in side.columns))  # columns that aren't the turns' own
        return turns.groupBy("base", "run").cogroup(side.groupBy("base", "run")).applyInArrow(f, schema)

    def _sums_before(self) -> DataFrame:
        """For each run of a conversation with more than one: sums of hashes and characters before it, and of all of it."""
        long = self.turns.where(F.col("pos") == RUN).select("conv")  # a row for each long conversation
        rows = keep(self.turns.join(long, "conv", "left_semi"), "long")

        def own(key, turns: pa.Table, side: pa.Table) -> pa.Table:
            base, run = _keys(key)
            p = rebuilt(turns, _heads(side), run)
            start = _groups(p["conv"])
            if not len(start):
                return _empty(_RUNS)
            s1, s2 = (np.add.reduceat(x, start).view(np.int64) for x in _place_hash(p["depth"], p["d1"], p["d2"]))
            return pa.table({"base": np.full(len(start), base), "run": np.full(len(start), run), "conv": p["conv"][start], "s1": s1, "s2": s2, "chars": np.add.reduceat(p["chars"], start), "turns": np.diff(np.r_[start, len(p["conv"])])})

        def running(runs: pa.Table) -> pa.Table:
            runs = runs.sort_by("run")
            col = {x: runs.column(x).to_numpy() for x in runs.column_names}
            earlier = lambda v: (np.cumsum(v, dtype=v.dtype) - v).view(np.int64)
            n = runs.num_rows
            return pa.table({"base": col["base"], "run": col["run"], "kind": np.ones(n, np.int64), "conv": col["conv"], "d1": earlier(col["s1"].view(np.uint64)), "d2": earlier(col["s2"].view(np.uint64)), "chars": earlier(col["chars"]), "total": np.full(n, col["chars"].sum()), "length": np.full(n, col["turns"].sum())})

        runs = self._cogroup(rows, own, _RUNS)
        return keep(runs.groupBy("conv").applyInArrow(running, _SUMS), "sums")  # a row for each RUN turns of a conversation

    def each(self, f, schema: str, *more: DataFrame) -> DataFrame:
        """f(base, paths with the root, further rows of kind 2) of each group."""

        def call(key, turns: pa.Table, side: pa.Table) -> pa.Table:
            base, run = _keys(key)
            if not turns.num_rows:
                return _empty(schema)
            p = _paths(turns, _heads(side), side.filter(pc.equal(side.column("kind"), 1)), run)
            return f(base, p if run else _with_root(p), side.filter(pc.equal(side.column("kind"), 2)))

        return self._cogroup(self.turns, call, schema, self.before, *more)


def _empty(schema: str) -> pa.Table:
    return pa.table({c.split()[0]: pa.array([], pa.int64()) for c in schema.split(", ")})


def _heads(side: pa.Table) -> pa.Table:
    own = side.filter(pc.equal(side.column("kind"), 0))
    return pa.table({"pos": own.column("conv"), "d1": own.column("d1"), "d2": own.column("d2"), "chars": own.column("chars")})


def _ends_hash(ends: DataFrame) -> DataFrame:
    """(k1, k2, ends_sha256): of each node's ended conversations, by id. Families write their ids, and a node's families follow each other
    in a sorted task, which holds a family's ids at a time."""
    families = ends.groupBy("k1", "k2", "base").agg(F.concat_ws(",", F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string"))).alias("ids"))
    dealt = families.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "base").select("k1", "k2", "ids")

    def hashed(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, digest = None, None
        for frame in frames:
            keys, found = [], []
            for k1, k2, ids in zip(*(frame.column(i).to_pylist() for i in range(3)), strict=True):
                if (k1, k2) == last:
                    digest.update(b"," + ids.encode())
                    continue
                if last is not None:
                    keys.append(last)
                    found.append(digest.hexdigest())
                last, digest = (k1, k2), hashlib.sha256(ids.encode())
            if keys:
                yield _hash_rows(keys, found)
        if last is not None:
            yield _hash_rows([last], [digest.hexdigest()])

    return dealt.mapInArrow(hashed, "k1 long, k2 long, ends_sha256 string")


def _hash_rows(keys: list[tuple[int, int]], found: list[str]) -> pa.RecordBatch:
    a, b = zip(*keys, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(found)], names=["k1", "k2", "ends_sha256"])


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of each node.

    Turns are ordered by turn, null first, then by role, the first HEAD characters of the text, and a digest of both; a null role or text is empty. Repeated
    rows are turns of their own. Rows without a conv_id take no part; an empty table has no nodes, not even the root. The base of an id is
    c - c % 100 with a remainder of the id's own sign, so that negative ids have one too. Further columns are ignored.
    """
    families = Families(ordered_turns(conversations))
    parts = families.each(family_nodes, _NODE)
    nodes = parts.groupBy("k1", "k2").agg(F.min("first").alias("conv_id"), F.min("depth").alias("depth"), F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.min("chars").alias("chars"), F.sum("n").alias("n_convs"), F.sum("weight").alias("weight"))
    nodes = keep(nodes, "nodes")
    children = nodes.where("depth > 0").groupBy("p1", "p2").agg(F.count("*").alias("n_children")).withColumnsRenamed({"p1": "k1", "p2": "k2"})
    nodes = keep(nodes.join(children, ["k1", "k2"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "children")
    # Of each conversation that has nodes: the first depth of them, the last that other members share, whether the last is a leaf, and
    # their characters.
    own = nodes.groupBy(F.col("conv_id").alias("conv")).agg(F.min("depth").alias("o"), F.max(F.when(F.col("n_convs") > 1, F.col("depth"))).alias("s"), F.max_by((F.col("n_children") == 0).cast("long"), "depth").alias("leaf"), F.sum("chars").alias("mine"))
    first = own.select((F.col("conv") - F.col("conv") % FAMILY).alias("base"), F.lit(0).cast("long").alias("run"), F.lit(2).cast("long").alias("kind"), "conv", "o", F.coalesce("s", F.col("o") - 1).alias("s"), "leaf", "mine")
    later = first.drop("run").join(families.before.where("run > 0").select("conv", "run"), "conv")
    given = keep(families.each(below, _BELOW, first.unionByName(later)), "below")
    sums = given.where("conv is null").groupBy("k1", "k2").agg(F.sum("chars").alias("below"), F.sum("leaves").alias("leaves"))
    parents = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(sums, ["k1", "k2"], "left").join(_ends_hash(given.where("conv is not null")), ["k1", "k2"], "left").join(parents, ["p1", "p2"], "left")
    shared = F.col("n_convs") > 1
    return out.select(
        "conv_id",
        "depth",
        F.when(F.col("depth") > 0, F.col("parent_conv_id")).alias("parent_conv_id"),
        "n_convs",
        "n_children",
        F.when(shared, F.col("leaves")).otherwise(1).cast("long").alias("n_leaves"),
        F.when(shared, F.col("weight") - F.col("below")).otherwise(0).cast("long").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
