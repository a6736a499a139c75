"""The trie of conversation prefixes, by truncation peeling."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import name_in, saved

#: Conversations below a node from which it is peeled after all others; more where that would leave over ``MOST_TOP`` such nodes.
LIMIT = 256
MOST_TOP = 200_000
#: Turns that one task peels at once, about.
SHARD_TURNS = 100_000
#: Ids of one text of a digest are ``1 << _SHIFT`` apart at most.
_SHIFT = 16

NODES = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, "
    "up_hi long, up_lo long, top boolean"
)


def digests(convs: DataFrame, *, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, place, digest, size``: the turns of each conversation by rank, from 1, with a digest of role and text and the text's bytes.

    Texts stay where they are; 60 bytes a turn are shuffled. Null turns come first; of equal turns the smaller role, then
    the smaller digest comes first. Null roles and texts are empty. Rows without a conversation id belong to none and go.
    """
    role, text = (F.coalesce(name_in(convs, c).cast("string"), F.lit("")) for c in (role, text))
    # The length keeps role and text apart.
    said = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    rows = convs.where(name_in(convs, id).isNotNull()).select(
        name_in(convs, id).cast("long").alias("conv_id"), name_in(convs, turn).alias("turn"), role.alias("role"), said.alias("digest"), F.octet_length(text).cast("long").alias("size"))
    rank = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "digest"))
    return rows.select("conv_id", rank.cast("long").alias("place"), "digest", "size")


def prefix_trie(convs: DataFrame, **names) -> DataFrame:
    """One row per node of the trie of all conversations, see ``trie``; ``names`` are those of ``digests``."""
    turns = digests(convs, **names)
    return trie(turns.unionByName(turns.where("place = 1").selectExpr("conv_id", "0L as place", "cast(null as string) as digest", "0L as size")))


def trie(turns: DataFrame, *, limit: int = LIMIT) -> DataFrame:
    """Nodes of the trie of conversations, whose turns are rows of ``digests``, with a row of place 0 for each conversation.

    A node of depth d is a distinct sequence of first d turns; the root has none. Returns ``conv_id`` (the smallest member), ``depth``,
    ``parent_conv_id`` (null at the root), ``n_convs`` (members), ``n_children``, ``n_leaves`` (childless nodes of the
    subtree), ``saved_tokens`` (over the subtree, members less one times the bytes of the node's last text) and ``ends_sha256``, a digest of the
    ids of conversations that end there. The node's own turn is turn ``depth`` of conversation ``conv_id``.

    Equal conversations are first made one, with their number and the digest of their ids. Then a task takes whole subtrees and peels
    them from the greatest depth up: conversations that end at a depth meet the nodes that survive from below, those of one key become a node, whose
    figures are final at once, and the node goes on without its last turn. Subtrees of more than ``limit`` conversations are cut at their
    heavy nodes: what lies below is peeled in many tasks, its sums are added up per heavy node before any shuffle, and heavy nodes, at
    most ``MOST_TOP`` whatever the input, are peeled in a last task. So no prefix is hot, however many conversations
    begin with it. A task holds the turns of ``limit`` conversations, or about ``SHARD_TURNS``.

    A node's key is 128 bits from the digests of its turns. Ids of one end are digested in their order by one task, in
    texts of bounded length. No conversations give no nodes; repeated rows are turns like others.
    """
    paths = saved(_paths(turns), "paths")
    ends = _ends(paths.where("last"))
    # One conversation for each distinct one; the number and the digest stand at its last turn.
    chosen = saved(
        paths.join(ends.withColumnRenamed("least", "conv_id"), "conv_id").select(
            "conv_id", "place", "hi", "lo", "up_hi", "up_lo", "size", F.when(F.col("last"), F.col("n")).otherwise(0).alias("n"), F.when(F.col("last"), F.col("ends")).alias("ends")),
        "chosen")
    turns_left = chosen.count()
    limit = max(limit, -(-turns_left // MOST_TOP))
    heavy = chosen.groupBy("hi", "lo").agg(F.count(F.lit(1)).alias("m"), F.min("conv_id").alias("least")).where(F.col("m") > limit)
    # At most turns / limit nodes are heavy, MOST_TOP in all.
    known = chosen.join(F.broadcast(heavy.select("hi", "lo", "least")), ["hi", "lo"], "left")
    path = Window.partitionBy("conv_id")
    light = F.col("least").isNull()
    known = saved(
        known.select(
            "*", F.min(F.when(light, F.struct("place", "hi", "lo"))).over(path).alias("root"),
            F.max(F.when(~light, F.struct("place", "least"))).over(path)["least"].alias("above")), "known")
    shards = max(int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-turns_left // SHARD_TURNS))
    below = known.where(light).withColumn("shard", F.pmod(F.xxhash64("root"), F.lit(shards))).drop("root", "least")
    peeled = saved(below.groupBy("shard").applyInArrow(_peel_paths, NODES), "peeled")
    given = peeled.where("top and depth > 0").groupBy(F.col("up_hi").alias("hi"), F.col("up_lo").alias("lo")).agg(
        F.sum("n_convs").alias("n"), F.min("conv_id").alias("least"), F.count(F.lit(1)).alias("kids"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
    own = known.where(~light).groupBy("hi", "lo", "place", "up_hi", "up_lo", "size").agg(
        F.sum("n").alias("n_ended"), F.min(F.when(F.col("n") > 0, F.col("conv_id"))).alias("ended"), F.max("ends").alias("ends"))
    top = own.join(given, ["hi", "lo"], "left").withColumn("one", F.lit(0)).groupBy("one").applyInArrow(_peel_nodes, NODES)
    return peeled.unionByName(top).drop("up_hi", "up_lo", "top")


def _paths(turns: DataFrame) -> DataFrame:
    """Turns with the key of the sequence they end and of the one before, from 128-bit values of digest and place joined by exclusive or."""
    order = Window.partitionBy("conv_id").orderBy("place")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    value = lambda k: F.when(F.col("digest").isNull(), F.lit(0)).otherwise(F.xxhash64(F.lit(k), F.col("place"), F.col("digest")))
    keyed = turns.select("conv_id", "place", "size", F.bit_xor(value(1)).over(so_far).alias("hi"), F.bit_xor(value(2)).over(so_far).alias("lo"), F.lead("place").over(order).isNull().alias("last"))
    return keyed.select("*", F.lag("hi").over(order).alias("up_hi"), F.lag("lo").over(order).alias("up_lo"))


def _ends(last: DataFrame) -> DataFrame:
    """``least, n, ends`` of each distinct conversation: smallest id, number of ids, digest of all ids in order."""
    block = F.shiftright("conv_id", _SHIFT)
    ids = last.groupBy("hi", "lo", block.alias("block")).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    texts = ids.select("hi", "lo", "block", F.col("ids")[0].alias("least"), F.size("ids").cast("long").alias("n"), F.array_join(F.col("ids").cast("array<string>"), ",").alias("text"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One run through sorted rows, a text at a time."""
        key, least, n, state = None, None, 0, None
        for batch in batches:
            out = []
            for hi, lo, first, m, text in zip(*(batch.column(c).to_pylist() for c in ("hi", "lo", "least", "n", "text")), strict=True):
                if (hi, lo) != key:
                    if key is not None:
                        out.append((least, n, state.hexdigest()))
                    key, least, n, state = (hi, lo), first, m, hashlib.sha256(text.encode())
                else:
                    n += m
                    state.update(b"," + text.encode())
            yield _ended(out)
        if key is not None:
            yield _ended([(least, n, state.hexdigest())])

    def _ended(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string()), strict=True)], names=["least", "n", "ends"])

    return texts.repartition("hi", "lo").sortWithinPartitions("hi", "lo", "block").select("hi", "lo", "least", "n", "text").mapInArrow(digest, "least long, n long, ends string")


def _groups(hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
    """A number for each row, the same for equal keys."""
    order = np.lexsort((lo, hi))
    new = np.concatenate(([True], (np.diff(hi[order]) != 0) | (np.diff(lo[order]) != 0)))
    out = np.empty(len(hi), np.int64)
    out[order] = np.cumsum(new) - 1
    return out


def peel(key: np.ndarray, depth: np.ndarray, up: np.ndarray, size: np.ndarray, n: np.ndarray, least: np.ndarray, kids: np.ndarray, leaves: np.ndarray, saved_: np.ndarray) -> dict[str, np.ndarray]:
    """Nodes met by peeling rows from the greatest depth up.

    A row is alive at its depth when conversations have arrived there (``n`` over 0): some that end, or a node
    from below that has lost its last turn. Living rows of one key are a node; one of them carries it to the row ``up``, or out where that is negative.
    ``row`` is the carrier, ``parent`` the parent's place among the nodes.
    """
    n, least, kids, leaves, saved_ = n.copy(), least.copy(), kids.copy(), leaves.copy(), saved_.copy()
    by_depth = np.argsort(-depth, kind="stable")
    bounds = np.flatnonzero(np.concatenate(([True], np.diff(depth[by_depth]) != 0, [True]))) if len(depth) else np.zeros(1, np.int64)
    node_of, made, carriers = np.full(len(depth), -1), 0, []
    found: dict[str, list[np.ndarray]] = {k: [] for k in ("n_convs", "conv_id", "n_children", "n_leaves", "saved_tokens")}
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        rows = by_depth[a:b]
        rows = rows[n[rows] > 0]
        _, first, group = np.unique(key[rows], return_index=True, return_inverse=True)
        m = len(first)
        convs, below, under, spared = (np.zeros(m, np.int64) for _ in range(4))
        smallest = np.full(m, np.iinfo(np.int64).max)
        np.add.at(convs, group, n[rows]), np.add.at(below, group, kids[rows]), np.add.at(under, group, leaves[rows]), np.add.at(spared, group, saved_[rows])
        np.minimum.at(smallest, group, least[rows])
        carrier = rows[first]
        under = np.where(below == 0, 1, under)
        spared += (convs - 1) * size[carrier]
        for name, values in zip(found, (convs, smallest, below, under, spared), strict=True):
            found[name].append(values)
        node_of[rows] = made + group
        made += m
        carriers.append(carrier)
        to, on = up[carrier], up[carrier] >= 0
        to = to[on]
        np.add.at(n, to, convs[on]), np.add.at(kids, to, 1), np.add.at(leaves, to, under[on]), np.add.at(saved_, to, spared[on])
        np.minimum.at(least, to, smallest[on])
    row = np.concatenate(carriers) if carriers else np.zeros(0, np.int64)
    out = {k: np.concatenate(v) if v else np.zeros(0, np.int64) for k, v in found.items()}
    return out | {"row": row, "parent": np.where(up[row] >= 0, node_of[up[row]], -1), "node_of": node_of}


def _numbers(table: pa.Table, name: str, missing: int = 0) -> np.ndarray:
    return table.column(name).fill_null(missing).to_numpy().astype(np.int64)


def _nodes(table: pa.Table, depth: np.ndarray, found: dict, above: np.ndarray, top: np.ndarray) -> pa.Table:
    row, parent = found["row"], found["parent"]
    inside = parent >= 0
    # What conversations end at a node stands at one of its rows.
    said, text = np.full(len(row), -1), table.column("ends").combine_chunks()
    at = np.flatnonzero(text.is_valid().to_numpy(zero_copy_only=False))
    said[found["node_of"][at]] = at
    ends = text.take(pa.array(said, mask=said < 0)).fill_null(hashlib.sha256(b"").hexdigest())
    over = np.where(inside, found["conv_id"][parent] if len(row) else 0, above[row])
    none = (depth[row] == 0) | (~inside & ~top[row])
    columns = {
        "conv_id": pa.array(found["conv_id"]), "depth": pa.array(depth[row]), "parent_conv_id": pa.array(over, mask=none),
        **{k: pa.array(found[k]) for k in ("n_convs", "n_children", "n_leaves", "saved_tokens")}, "ends_sha256": ends,
        "up_hi": table.column("up_hi").combine_chunks().take(pa.array(row)), "up_lo": table.column("up_lo").combine_chunks().take(pa.array(row)), "top": pa.array(~inside & top[row])}
    return pa.table(columns)


def _peel_paths(table: pa.Table) -> pa.Table:
    """Whole subtrees as paths of conversations."""
    conv, depth = _numbers(table, "conv_id"), _numbers(table, "place")
    table = table.take(pa.array(np.lexsort((depth, conv))))
    conv, depth = _numbers(table, "conv_id"), _numbers(table, "place")
    same = np.concatenate(([False], conv[1:] == conv[:-1]))
    up, n = np.where(same, np.arange(len(conv)) - 1, -1), _numbers(table, "n")
    zero = np.zeros(len(conv), np.int64)
    found = peel(_groups(_numbers(table, "hi"), _numbers(table, "lo")), depth, up, _numbers(table, "size"), n, np.where(n > 0, conv, np.iinfo(np.int64).max), zero, zero, zero)
    return _nodes(table, depth, found, _numbers(table, "above"), np.ones(len(conv), bool))


def _peel_nodes(table: pa.Table) -> pa.Table:
    """The heavy nodes, with what has been summed up below them."""
    hi, lo, depth = _numbers(table, "hi"), _numbers(table, "lo"), _numbers(table, "place")
    place = {k: i for i, k in enumerate(zip(hi.tolist(), lo.tolist(), strict=True))}
    up = np.array([place[k] if d > 0 else -1 for k, d in zip(zip(_numbers(table, "up_hi").tolist(), _numbers(table, "up_lo").tolist(), strict=True), depth.tolist(), strict=True)], np.int64)
    most = np.iinfo(np.int64).max
    found = peel(
        np.arange(len(hi)), depth, up, _numbers(table, "size"), _numbers(table, "n") + _numbers(table, "n_ended"),
        np.minimum(_numbers(table, "least", most), _numbers(table, "ended", most)), _numbers(table, "kids"), _numbers(table, "leaves"), _numbers(table, "saved"))
    return _nodes(table, depth, found, np.zeros(len(hi), np.int64), np.zeros(len(hi), bool))


def rebuilt(turns: DataFrame, family: Column, head: Column, most: int) -> DataFrame:
    """Turns of ``digests`` where each conversation begins with the first ``head`` turns of conversation ``family`` and goes on after its own first ``head``.

    ``family`` and ``head`` are expressions of ``conv_id``, ``head`` at most ``most``. The rows of a family meet once: all
    that follows is done where they are. Each conversation also has a row of place 0.
    """
    dealt = turns.withColumn("family", family).repartition("family").withColumn("present", F.collect_set("conv_id").over(Window.partitionBy("family")))
    lent = F.when(
        (F.col("conv_id") == F.col("family")) & (F.col("place") <= most),
        F.transform("present", lambda c: F.struct(c.alias("conv_id"), F.lit(1).alias("part"))))
    own = F.array(F.struct(F.col("conv_id"), F.lit(2).alias("part")), F.struct(F.when(F.col("place") == 1, F.col("conv_id")).alias("conv_id"), F.lit(0).alias("part")))
    rows = dealt.select("family", "place", "digest", "size", F.explode(F.concat(own, F.coalesce(lent, F.array().cast("array<struct<conv_id:bigint,part:int>>")))).alias("to"))
    rows = rows.select("family", "place", F.col("to.conv_id").alias("conv_id"), F.col("to.part").alias("part"), "digest", "size").withColumn("head", head)
    rows = rows.where("conv_id is not null and (part = 0 or part = 1 and place <= head or part = 2 and place > head)")
    order = Window.partitionBy("family", "conv_id").orderBy("part", "place")
    marker = F.col("part") == 0
    return rows.select(
        "conv_id", (F.row_number().over(order) - 1).cast("long").alias("place"),
        F.when(~marker, F.col("digest")).alias("digest"), F.when(marker, F.lit(0)).otherwise(F.col("size")).cast("long").alias("size"))
