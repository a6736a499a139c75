"""Near-duplicate groups by ProbMinHash signatures, banding and exact verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from .common import fold, name_in, saved

_STEP = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0x100000001B3)
#: Bytes of text hashed at once in one worker.
_CHUNK = 1 << 19


def _mix(x: np.ndarray) -> np.ndarray:
    """A well-mixed 64-bit value of each 64-bit value."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingles:
    """Hashes of the runs of ``size`` words of a text; one run of all words where there are fewer."""

    def __init__(self, size: int):
        self._size = size
        self._power = np.ones(_CHUNK + 1, np.uint64)
        np.multiply.accumulate(np.full(_CHUNK, _BASE), out=self._power[1:])
        self._inverse = np.ones(_CHUNK + 1, np.uint64)
        np.multiply.accumulate(np.full(_CHUNK, np.uint64(pow(int(_BASE), -1, 1 << 64))), out=self._inverse[1:])

    def _words(self, folded: bytes) -> np.ndarray:
        """A hash per word, by differences of one running sum over the bytes."""
        raw = np.frombuffer(folded, np.uint8)
        edges = np.flatnonzero(np.diff(np.concatenate(([0], (raw != 32).view(np.int8), [0]))))
        start, stop = edges[::2], edges[1::2]
        total = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * self._power[: len(raw)], out=total[1:])
        return _mix((total[stop] - total[start]) * self._inverse[start] + (stop - start).astype(np.uint64))

    def __call__(self, text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
        """Distinct hashes in order, and how often each occurs; none for null or a text without words."""
        folded, parts, at = fold(text or b""), [], 0
        while at < len(folded):
            stop = min(at + _CHUNK, len(folded))
            if stop < len(folded) and (cut := folded.rfind(b" ", at, stop)) > at:
                stop = cut  # words are not cut, unless one is longer than a chunk
            parts.append(self._words(folded[at:stop]))
            at = stop
        words = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        if not len(words):
            return words, np.zeros(0, np.int64)
        runs = max(1, len(words) - self._size + 1)
        joined = np.full(runs, np.uint64(0))
        for k in range(min(self._size, len(words))):
            joined = _mix(joined * _BASE + words[k : k + runs] + _STEP)
        return np.unique(joined, return_counts=True)


def prob_minhash(elements: list[tuple[np.ndarray, np.ndarray]], registers: int) -> np.ndarray:
    """Signatures of weighted sets: two of them agree in a register with the probability Jaccard similarity of the sets.

    Each element starts a Poisson process whose rate is its weight; each arrival
    goes to a register drawn for it, which keeps the element that arrived first. An
    element stops once its next arrival is later than all registers of its set, which
    is why most stop after one or two. All sets advance together.
    """
    signature = np.zeros((len(elements), registers), np.uint64)
    first = np.full((len(elements), registers), np.inf)
    owner = np.repeat(np.arange(len(elements)), [len(e) for e, _ in elements])
    if not len(owner):
        return signature
    element = np.concatenate([e for e, _ in elements])
    weight = np.concatenate([w for _, w in elements]).astype(np.float64)
    time, state = np.zeros(len(owner)), element.copy()
    flat, best = first.reshape(-1), signature.reshape(-1)
    while len(owner):
        state = state + _STEP
        draw = _mix(state)
        time = time - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53) / weight
        place = owner * registers + (_mix(draw) % np.uint64(registers)).astype(np.int64)
        early = np.flatnonzero(time < flat[place])
        order = early[np.lexsort((element[early], time[early], place[early]))]
        won = order[np.concatenate(([True], np.diff(place[order]) != 0))] if len(order) else order
        flat[place[won]], best[place[won]] = time[won], element[won]
        stay = time < first.max(axis=1)[owner]
        owner, element, weight, time, state = owner[stay], element[stay], weight[stay], time[stay], state[stay]
    return signature


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum over common elements i of 1 / sum over j of max(a_j / a_i, b_j / b_i); plain Jaccard where all weights are equal.

    For a common element the maximum is a_j / a_i for those j whose a_j / b_j is at
    least a_i / b_i, so sorting by that ratio leaves running sums.
    """
    common, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    x, y = a[1][i].astype(np.float64), b[1][j].astype(np.float64)
    only_a, only_b = a[1].sum() - x.sum(), b[1].sum() - y.sum()
    if (x == 1).all() and (y == 1).all():
        return len(common) / (len(common) + only_a + only_b)
    order = np.argsort(x / y, kind="stable")
    x, y = x[order], y[order]
    below, above = np.concatenate(([0], np.cumsum(y)))[:-1], x[::-1].cumsum()[::-1]
    return float(np.sum(1.0 / ((above + only_a) / x + (below + only_b) / y)))


def near_duplicates(
    docs: DataFrame, *, id: str = "doc_id", text: str = "text", size: int = 5, threshold: float = 0.8, bands: int = 25, rows: int = 5,
) -> DataFrame:
    """One row per document: ``doc_id`` and ``class_id``, the smallest id of its group.

    Two texts are linked when the probability Jaccard similarity of their shingles of
    ``size`` words, weighted by how often they occur, is at least ``threshold``; a group
    is what links connect. Texts that are equal are one text from the start, so copies
    are never paired.

    1. Each text gets a signature of ``bands * rows`` registers; texts that agree in
       all ``rows`` registers of a band are candidates. A pair at 0.8 is missed with
       probability (1 - 0.8**5)**25 = 0.00005.
    2. In each band's bucket the text with most copies leads. Every text is verified against the lead of the largest of its
       buckets, which links it once at most; the links are joined into components.
    3. A text is then verified against the leads of its other buckets, where these are in other components. A link
       now joins two components, whatever number of texts found it.
    4. Where a bucket still holds several components, all texts outside its largest one
       are verified against all its texts of other components, in blocks of bounded size, each of which gives
       a spanning forest of what it links. So every candidate pair is either in one component or
       verified, and a bucket whose texts are alike costs one comparison a text. Texts by
       the thousand that share a bucket and yet are not alike cost their square, in
       blocks spread over the cluster; only links leave a block, never pairs.

    A null or wordless text has no shingles: it is linked to equal texts only, a null
    text to none. Rows that repeat an id come out as often as they came in; null ids
    get a null class and join no group. No documents give no rows; other columns are not carried.
    """
    return _classes(docs, id, text, size, threshold, bands, rows).select("doc_id", "class_id")


def _classes(docs: DataFrame, id: str, text: str, size: int, threshold: float, bands: int, rows: int) -> DataFrame:
    """``doc_id, digest, class_id, first`` of each row; ``first`` is the digest, among texts with the class's smallest id the smallest, of the one that stands for the class."""
    chosen = docs.select(name_in(docs, id).alias("doc_id"), name_in(docs, text).cast("string").alias("text"))
    kind = chosen.schema["doc_id"].dataType
    signed = saved(_signed(chosen, kind, size, bands, rows), "signatures")
    # One row for all texts that are equal.
    texts = saved(
        signed.where("doc_id is not null and digest is not null").groupBy("digest")
        .agg(F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("copies"), F.first("bytes").alias("bytes"), F.first("buckets").alias("buckets")), "texts")
    buckets = texts.where("buckets is not null").select("digest", "copies", "bytes", F.posexplode("buckets").alias("band", "bucket"))
    crowd = buckets.groupBy("band", "bucket").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("copies", "digest"))["digest"].alias("lead")).where("n > 1")
    main = F.max(F.when(F.col("digest") != F.col("lead"), F.struct("n", "lead"))).over(Window.partitionBy("digest"))["lead"]
    members = saved(buckets.join(crowd, ["band", "bucket"]).withColumn("main", main).drop("n", "copies"), "buckets")
    bodies = _bodies(chosen, members)

    star = members.where("main is not null").select(F.col("main").alias("a"), F.col("digest").alias("b")).distinct()
    groups = components(saved(_verified(star, bodies, threshold, size), "star"))
    groups = _joined(groups, _verified_leads(members, groups, bodies, threshold, size))
    groups = _joined(groups, _verified_across(members, groups, bodies, threshold, size))

    # From texts to documents: the class is the smallest id of all texts of the component.
    named = texts.join(groups, texts["digest"] == groups["node"], "left").select(
        "digest", F.coalesce("component", "digest").alias("component"), texts["node"])
    least = named.groupBy("component").agg(F.min(F.struct("node", "digest")).alias("least"))
    classes = named.join(least, "component").select("digest", F.col("least.node").alias("class_id"), F.col("least.digest").alias("first"))
    out = signed.select("doc_id", "digest").join(classes, "digest", "left")
    return out.select("doc_id", "digest", F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id")).alias("class_id"), "first")


def deduplicated(
    docs: DataFrame, *, id: str = "doc_id", text: str = "text", size: int = 5, threshold: float = 0.8, bands: int = 25, rows: int = 5,
) -> DataFrame:
    """The documents that stay: of each group the one with the smallest id, with all its columns.

    Rows that agree in id and text are copies of a row and are dropped to one; of different texts with the smallest id of one
    group, the one with the smallest digest stays. An id that stands on texts of several groups is one document in each.
    Rows with a null id stay as they are; null texts are in no group, so each id keeps one.
    """
    found = _classes(docs, id, text, size, threshold, bands, rows)
    taken, names = {c.lower() for c in docs.columns}, []
    for name in ("id_", "first_", "digest_"):
        while name in taken:
            name += "_"
        names.append(name)
    own, first, digest = names
    # No digest is empty, so that it stands for null text and one shuffle by id and digest serves both what follows.
    known = lambda c: F.coalesce(c, F.lit(""))
    stay = found.where("doc_id = class_id and digest <=> first").select(F.col("doc_id").alias(own), known(F.col("digest")).alias(first)).distinct()
    marked = docs.withColumn(digest, known(F.md5(name_in(docs, text).cast("string").cast("binary"))))
    same = (name_in(docs, id) == F.col(own)) & (F.col(digest) == F.col(first))
    kept = marked.join(stay, same, "left_semi").dropDuplicates([id, digest]).drop(digest)
    return kept.unionByName(docs.where(name_in(docs, id).isNull()))


def _signed(chosen: DataFrame, kind: T.DataType, size: int, bands: int, rows: int) -> DataFrame:
    """``doc_id, digest, bytes, buckets``: a checksum of the text, its length, and a key per band, null without words."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingles(size)
        for whole in batches:
            lengths, at = whole.column("bytes").fill_null(0).to_pylist(), 0
            while at < len(whole):
                stop, volume = at + 1, lengths[at]
                while stop < len(whole) and volume + lengths[stop] <= 4 * _CHUNK and stop - at < 4096:
                    volume += lengths[stop]
                    stop += 1
                batch, at = whole.slice(at, stop - at), stop
                sets = [shingle(t.as_py()) for t in batch.column("raw")]
                signature = prob_minhash(sets, bands * rows).reshape(len(batch), bands, rows)
                key = np.zeros((len(batch), bands), np.uint64)
                for k in range(rows):
                    key = _mix(key * _BASE + signature[:, :, k] + _STEP)
                buckets = [k if len(s[0]) else None for k, s in zip(key.view(np.int64).tolist(), sets, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("digest"), batch.column("bytes"), pa.array(buckets, pa.list_(pa.int64()))],
                    names=["doc_id", "digest", "bytes", "buckets"])

    raw = F.col("text").cast("binary")
    rows_ = chosen.select("doc_id", F.md5(raw).alias("digest"), F.length(raw).cast("long").alias("bytes"), raw.alias("raw"))
    schema = T.StructType([*rows_.schema.fields[:3], T.StructField("buckets", T.ArrayType(T.LongType()))])
    return rows_.mapInArrow(sign, schema)


def _bodies(chosen: DataFrame, members: DataFrame) -> DataFrame:
    """The text of each candidate, once."""
    wanted = members.select("digest").distinct()
    with_key = chosen.where("text is not null").select(F.md5(F.col("text").cast("binary")).alias("digest"), F.col("text").cast("binary").alias("raw"))
    return saved(with_key.join(wanted, "digest", "left_semi").dropDuplicates(["digest"]), "candidates")


def _verified(pairs: DataFrame, bodies: DataFrame, threshold: float, size: int) -> DataFrame:
    """``a, b`` of those pairs whose texts are as similar as asked for. Pairs with one ``a`` stand together, so its shingles are made once."""
    both = (
        pairs.join(bodies.select(F.col("digest").alias("b"), F.col("raw").alias("y")), "b")
        .join(bodies.select(F.col("digest").alias("a"), F.col("raw").alias("x")), "a")
        .select("a", "b", "x", "y")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle, last = Shingles(size), (None, None)
        for batch in batches:
            linked = []
            for a, x, y in zip(batch.column("a").to_pylist(), batch.column("x"), batch.column("y"), strict=True):
                if last[0] != a:
                    last = (a, shingle(x.as_py()))
                linked.append(probability_jaccard(last[1], shingle(y.as_py())) >= threshold)
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return both.mapInArrow(compare, "a string, b string")


def _verified_leads(members: DataFrame, groups: DataFrame, bodies: DataFrame, threshold: float, size: int) -> DataFrame:
    """``a, b`` of components that a text and the lead of one of its other buckets link."""
    name = lambda by, to: groups.select(F.col("node").alias(by), F.col("component").alias(to))
    left = members.where("digest <> lead and lead <> main").select("digest", "lead").distinct()
    left = left.join(name("digest", "own"), "digest", "left").join(name("lead", "other"), "lead", "left")
    left = left.withColumns({"own": F.coalesce("own", "digest"), "other": F.coalesce("other", "lead")}).where("own <> other")
    left = saved(left, "leads")
    found = _verified(left.select(F.col("lead").alias("a"), F.col("digest").alias("b")), bodies, threshold, size)
    found = found.join(left, (F.col("a") == F.col("lead")) & (F.col("b") == F.col("digest")))
    return saved(found.select(F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b")).distinct(), "linked")


def _joined(groups: DataFrame, links: DataFrame) -> DataFrame:
    """Groups after links between their components; a text without a group is its own component."""
    if links.isEmpty():
        return groups
    wider = components(links).toDF("component", "wider")
    known = groups.join(wider, "component", "left").select("node", F.coalesce("wider", "component").alias("component"))
    # Components of one text have no row yet.
    alone = wider.join(groups.select(F.col("node").alias("component")), "component", "left_anti").toDF("node", "component")
    return saved(known.unionByName(alone), "groups")


#: Texts, and bytes of text, in one of the two blocks that a task compares, about.
BLOCK_TEXTS, BLOCK_BYTES = 256, 4 << 20


def _verified_across(members: DataFrame, groups: DataFrame, bodies: DataFrame, threshold: float, size: int) -> DataFrame:
    """``a, b`` of components that are linked by texts that share a bucket.

    A bucket's texts outside its largest component are one side, all its texts the other. Each
    side is dealt into blocks by a hash, and each pair of blocks is compared in one task.
    """
    placed = members.join(groups, members["digest"] == groups["node"], "left").select(
        "band", "bucket", "digest", "bytes", F.coalesce("component", "digest").alias("component"))
    per = placed.groupBy("band", "bucket", "component").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"))
    per = per.groupBy("band", "bucket").agg(
        F.count(F.lit(1)).alias("kinds"), F.sum("n").alias("n"), F.sum("bytes").alias("bytes"), F.max(F.struct("n", "bytes", "component")).alias("main"))
    blocks = lambda n, b: F.ceil(F.greatest(n / BLOCK_TEXTS, b / BLOCK_BYTES, F.lit(1))).cast("int")
    per = per.where("kinds > 1").select(
        "band", "bucket", F.col("main.component").alias("main"), blocks(F.col("n"), F.col("bytes")).alias("all"),
        blocks(F.col("n") - F.col("main.n"), F.col("bytes") - F.col("main.bytes")).alias("few"))
    open_ = placed.join(per, ["band", "bucket"])
    own = lambda k: F.pmod(F.xxhash64("digest"), F.col(k)).cast("int")
    other = lambda k: F.explode(F.sequence(F.lit(0), F.col(k) - 1))
    few = open_.where("component <> main").select("band", "bucket", own("few").alias("i"), other("all").alias("j"), "digest", "component", F.lit(True).alias("first"))
    rest = open_.select("band", "bucket", other("few").alias("i"), own("all").alias("j"), "digest", "component", F.lit(False).alias("first"))
    sides = few.unionByName(rest).join(bodies, "digest")

    def compare(table: pa.Table) -> pa.Table:
        shingle, sets = Shingles(size), {}
        for name, raw in zip(table.column("digest").to_pylist(), table.column("raw"), strict=True):
            if name not in sets:
                sets[name] = shingle(raw.as_py())
        place = {name: k for k, name in enumerate(sets)}
        rows = list(zip(*(table.column(n).to_pylist() for n in ("digest", "component", "first")), strict=True))
        a, b = [r for r in rows if r[2]], [r for r in rows if not r[2]]
        may = _likely(list(sets.values()), threshold)[np.ix_([place[r[0]] for r in a], [place[r[0]] for r in b])]
        # A spanning forest of the components that this block links.
        root: dict[str, str] = {}

        def find(name: str) -> str:
            while (up := root.get(name, name)) != name:
                root[name] = root.get(up, up)
                name = up
            return name

        found: list[tuple[str, str]] = []
        for i, j in np.argwhere(may).tolist():
            left, right = find(a[i][1]), find(b[j][1])
            if left != right and probability_jaccard(sets[a[i][0]], sets[b[j][0]]) >= threshold:
                root[max(left, right)] = min(left, right)
                found.append((a[i][1], b[j][1]))
        return pa.table({"a": pa.array([x for x, _ in found], pa.string()), "b": pa.array([y for _, y in found], pa.string())})

    linked = sides.groupBy("band", "bucket", "i", "j").applyInArrow(compare, "a string, b string")
    return saved(linked.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "across")


def _likely(sets: list[tuple[np.ndarray, np.ndarray]], threshold: float) -> np.ndarray:
    """Which pairs of sets may be similar enough, by matrix products over the elements that two sets have.

    Where all weights are 1 that is the similarity itself. Else it is a bound: for a common
    element i, the sum over j of max(a_j / a_i, b_j / b_i) is at least the sum of either, so
    the similarity is at most the share that common elements have of either set's weight.
    """
    universe, at, often = np.unique(np.concatenate([s[0] for s in sets]), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), [len(s[0]) for s in sets])
    weight = np.concatenate([s[1] / s[1].sum() for s in sets]).astype(np.float32)
    column = np.cumsum(often > 1) - 1
    shared = often[at] > 1
    owner, at, weight = owner[shared], column[at[shared]], weight[shared]
    width, share = int((often > 1).sum()), np.zeros((len(sets), len(sets)), np.float64)
    for low in range(0, width, 4096):
        some = (at >= low) & (at < low + 4096)
        has = np.zeros((len(sets), min(4096, width - low)), np.float32)
        part = has.copy()
        has[owner[some], at[some] - low], part[owner[some], at[some] - low] = 1, weight[some]
        share += part @ has.T
    size = np.array([len(s[0]) for s in sets])
    plain = np.array([(s[1] == 1).all() for s in sets])
    common = share * size[:, None]
    exact = common / np.maximum(size[:, None] + size[None, :] - common, 1)
    return np.where(plain[:, None] & plain[None, :], exact, np.minimum(share, share.T)) >= threshold - 1e-4


def components(links: DataFrame) -> DataFrame:
    """``node, component`` of every node that has a link; a component is named by its smallest node.

    In each round a node takes the smallest name among its neighbours, and then the name
    that this one has by now, so names travel twice as far each round. Rounds
    end when no name changes; each is written to the shared folder.
    """
    edges = saved(links.select("a", "b").union(links.select("b", "a")).distinct().toDF("node", "other"), "edges")
    named = saved(edges.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("component")), "names")
    while True:
        near = edges.join(named.withColumnRenamed("node", "other"), "other").groupBy("node").agg(F.min("component").alias("near"))
        lower = named.join(near, "node").select("node", "component", F.least("component", "near").alias("name"))
        jump = named.select(F.col("node").alias("name"), F.col("component").alias("far"))
        new = saved(lower.join(jump, "name", "left").select("node", F.col("component").alias("old"), F.least("name", "far").alias("component")), "names")
        named = new.select("node", "component")
        if new.where("old <> component").isEmpty():
            return named
