"""N-gram Jaccard join by a MinHash LSH forest with exact verification.

Each tree of the forest is a prefix trie of signatures; a node is the group of texts that share a prefix. The deepest nodes are
compared first. Prefixes are then shortened, as far as the links found so far say is needed for the target recall, and only
pairs that share no longer prefix are compared again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featherline.llm.common import lean, materialize, row_ids, table, unused
from featherline.llm.decontaminate import WordHashes, contract_words, gram_hashes

#: Up to so many ids or nodes are sent to all tasks (16 MB); more are joined by a shuffle.
MOST_SENT = 1_000_000
#: Links are counted by similarity in so many steps from 0 to 1, and recall is asked of each band of these steps.
STEPS, BAND = 100, 5


def shingles(text: str | None, seen: WordHashes, n: int = 5) -> np.ndarray:
    """Sorted 64-bit hashes of the different runs of n words (lower-cased, digits, letters and non-ASCII); all words at once if there are fewer than n; empty without words."""
    own = contract_words(text)
    if not own:
        return np.empty(0, np.uint64)
    return np.unique(gram_hashes(seen.of(own), min(n, len(own))))


def chance(similarity: np.ndarray, depth: int, trees: int) -> np.ndarray:
    """How likely two texts of that similarity share a prefix of that depth in some tree."""
    return 1 - (1 - similarity**depth) ** trees


def recall_at(links: np.ndarray, depth: int, trees: int) -> float:
    """The least recall, over bands of similarity, that prefixes of a depth have by the links found (counts by similarity in
    STEPS steps): each link found stands for one over its chance. 1 without links."""
    i = np.flatnonzero(links)
    found = np.bincount(i // BAND, links[i])
    there = np.bincount(i // BAND, links[i] / chance(np.minimum((i + 0.5) / STEPS, 1.0), depth, trees))
    return float((found[found > 0] / there[found > 0]).min(initial=1.0))


def shortened(links: np.ndarray, depth: int, trees: int, recall: float) -> int:
    """The next depth: the longest shorter prefix that the links found so far need; 0 if the present depth will do."""
    while depth > 0 and recall_at(links, depth, trees) < recall:
        depth -= 1
        if depth and recall_at(links, depth, trees) >= recall:
            return depth
    return 0


class Forest:
    """Seeds of trees x deepest hash functions over shingles."""

    def __init__(self, trees: int, deepest: int):
        r = np.random.default_rng(11)
        self.trees, self.deepest = trees, deepest
        self.a = r.integers(0, 1 << 31, (trees * deepest, 1), np.uint32) << np.uint32(1) | np.uint32(1)
        self.b = r.integers(0, 1 << 32, (trees * deepest, 1), np.uint32)

    def signature(self, sh: np.ndarray) -> np.ndarray:
        """Least hash values, 32 bits each, trees after one another."""
        x = (sh >> np.uint64(32)).astype(np.uint32)
        out = np.full(len(self.a), 0xFFFFFFFF, np.uint32)
        for i in range(0, len(x), 2048):
            np.minimum(out, (self.a * x[i : i + 2048] + self.b).min(1), out=out)
        return out

    def prefixes(self, signature: Column, depth: int) -> Column:
        """Hashes of the prefixes of each tree, none of them 0."""
        return F.array(*[F.xxhash64(F.lit(t), F.substring(signature, 1 + 4 * self.deepest * t, 4 * depth)).bitwiseOR(F.lit(1).cast("long")) for t in range(self.trees)])


def _intersections(a: np.ndarray, b: np.ndarray) -> int:
    both = np.concatenate([a, b])
    both.sort()
    return int((both[1:] == both[:-1]).sum())


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, root): the least node that each node with an edge is connected to.

    Each round every root follows the least roots touched to the last one, by doubling until nothing changes, and edges move
    to the roots; ends when none is left. At most half of a component's roots are left after two rounds, and doublings are
    the logarithm of the longest way, so long paths take few steps. Rounds are written to the shared folder. Nothing is
    gathered on the driver.
    """
    left = materialize(edges.select("a", "b").filter("a <> b").distinct(), f"{name}-edges")
    nodes = left.select(F.col("a").alias("node")).union(left.select("b")).distinct().withColumn("root", F.col("node"))
    while left.take(1):
        both = left.union(left.select("b", "a"))
        up = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("root"), F.least("a", "m").alias("up"))
        up, moving = materialize(up, f"{name}-up"), True
        while moving:
            up = up.select("root", "up").join(up.select(F.col("root").alias("up"), F.col("up").alias("up2")), "up", "left")
            up = materialize(up.select("root", F.coalesce("up2", "up").alias("up"), (F.col("up2") < F.col("up")).alias("moved")), f"{name}-up")
            moving = bool(up.filter("moved").take(1))
        nodes = materialize(nodes.join(up, "root", "left").select("node", F.coalesce("up", "root").alias("root")), f"{name}-nodes")
        moved = left.join(up.select(F.col("root").alias("a"), F.col("up").alias("a2")), "a", "left").join(up.select(F.col("root").alias("b"), F.col("up").alias("b2")), "b", "left")
        moved = moved.select(F.coalesce("a2", "a").alias("a"), F.coalesce("b2", "b").alias("b")).filter("a <> b")
        left = materialize(moved.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), f"{name}-edges")
    return nodes


def join(docs: DataFrame, *, threshold: float = 0.8, n: int = 5, trees: int = 16, deepest: int = 8, recall: float = 0.998, block: int = 512, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row with its class of similar texts: rid, doc_id, th (hash of its text), rep (its text's representative), root (of
    its class), class_id, class_size, n_copies, n_links.

    Texts with the same set of word n-grams are one text, held by the row of least rid. Nodes of the forest at its deepest
    level are compared first; then links, counted by similarity, say what share of all links prefixes of that depth find, and
    prefixes are shortened until that is the target recall in every band of similarity. A node whose texts also share a
    node of an earlier tree, or of a deeper level, has nothing new and is left out; a pair is compared in the first tree it shares. Nodes are
    compared in blocks of `block` texts (fewer of long ones), a pair of blocks at a time, so that large nodes spread over
    tasks; copies are one text, so they make no pairs. All compared pairs are compared exactly. Out of a block come counts
    and the links of a spanning forest, not all pairs. Only links make classes. n_links is the number of other texts found at
    or above the threshold; n_copies that of other rows with the same n-grams. class_id is the least doc_id of the class.

    Rows without words (null and empty texts too) are alone in their class. Texts of fewer than n words are one n-gram. Null
    ids and repeated rows are rows of their own; ties go to the least rid; other columns are not read, whatever their names; an empty table gives no
    rows.
    """
    forest = Forest(trees, deepest)
    docs = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"), F.xxhash64(f"`{text}`").alias("th"))
    base = materialize(docs.mapInArrow(lean(_describer(forest, n)), "rid long, doc_id long, th long, digest binary, sig binary, n_sh int"), "forest-rows")
    texts = base.filter("digest is not null").groupBy("digest").agg(F.min(F.when(F.col("sig").isNotNull(), F.col("rid"))).alias("rep"), F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("least_doc"))
    texts = materialize(texts, "forest-texts")
    reps = texts.select(F.col("rep").alias("rid"))
    held = materialize(base.filter("sig is not null").join(_sent(reps), "rid", "left_semi").select("rid", "doc_id", "th", "sig", "n_sh"), "forest-signatures")

    links, found, depth, before = np.zeros(STEPS + 1), None, deepest, None
    while depth:
        compared = materialize(_level(docs, held, forest, depth, before, threshold, n, block), "forest-compared")
        found = compared if found is None else found.union(compared)
        for r in compared.select(F.posexplode("sims").alias("at", "n")).groupBy("at").agg(F.sum("n").alias("n")).collect():  # STEPS + 1 rows at most
            links[r.at] += r.n
        before, depth = depth, shortened(links, depth, trees, recall)

    roots = materialize(components(found.filter("b is not null").select("a", "b"), "classes"), "forest-classes")
    counted = found.filter("n is not null").groupBy("a").agg(F.sum("n").alias("n_links"))
    of_text = texts.join(roots.toDF("rep", "root"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    of_text = materialize(of_text.join(counted.toDF("rep", "n_links"), "rep", "left").select("digest", "rep", "root", "copies", "least_doc", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")), "forest-of-text")
    classes = of_text.groupBy("root").agg(F.min("least_doc").alias("class_id"), F.sum("copies").alias("class_size"))
    of_text = of_text.join(classes, "root").select("digest", "rep", "root", "class_id", "class_size", (F.col("copies") - 1).alias("n_copies"), "n_links")
    rows = base.select("rid", "doc_id", "th", "digest").join(of_text, "digest", "left")
    return rows.select("rid", "doc_id", "th", F.coalesce("rep", "rid").alias("rep"), F.coalesce("root", "rid").alias("root"), F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"), F.coalesce("n_copies", F.lit(0)).cast("long").alias("n_copies"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def _sent(df: DataFrame) -> DataFrame:
    """A written table, sent to all tasks if it has no more rows than that."""
    return F.broadcast(df) if df.count() <= MOST_SENT else df


def _describer(forest: Forest, n: int):
    schema = pa.schema([("rid", pa.int64()), ("doc_id", pa.int64()), ("th", pa.int64()), ("digest", pa.binary()), ("sig", pa.binary()), ("n_sh", pa.int32())])

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, seen = row_ids(), WordHashes()
        sent: set[bytes] = set()
        for b in batches:
            rows = []
            for key, x, th in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist(), strict=True):
                sh = shingles(x.as_py(), seen, n)
                row = {"rid": next(ids), "doc_id": key, "th": th, "digest": None, "sig": None, "n_sh": len(sh)}
                if len(sh):
                    row["digest"] = xxhash.xxh3_128_digest(sh.tobytes())
                    if row["digest"] not in sent:  # one of the equal ones of a task is enough
                        if len(sent) < 50_000:
                            sent.add(row["digest"])
                        row["sig"] = forest.signature(sh).tobytes()
                rows.append(row)
                if len(rows) >= 500:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows = []
            yield pa.RecordBatch.from_pylist(rows, schema)

    return describe


def _level(docs: DataFrame, held: DataFrame, forest: Forest, depth: int, before: int | None, threshold: float, n: int, block: int) -> DataFrame:
    """What is new among the nodes of a depth, given that those of the depth `before` were compared: see _compare."""
    keys, deeper = forest.prefixes(F.col("sig"), depth), forest.prefixes(F.col("sig"), before) if before else F.array().cast("array<long>")
    arrays = held.select("rid", "n_sh", keys.alias("keys"), deeper.alias("deeper"))
    planted = arrays.select("*", F.posexplode("keys").alias("t", "key"))
    shared = materialize(planted.groupBy("key").count().filter("count > 1").select("key"), "forest-shared")
    if shared.count() <= MOST_SENT:
        members = planted.join(F.broadcast(shared), "key")
    else:  # thin rows first
        members = planted.select("rid", "t", "key").join(shared, "key").join(arrays, "rid")
    members = materialize(members.select("key", "t", "rid", "n_sh", "keys", "deeper"), "forest-members")

    # a node with all its texts in one node of an earlier tree, or of the deeper level, has no pair of its own
    ends = [(F.min(F.get(c, F.lit(i))), F.max(F.get(c, F.lit(i)))) for c, m in (("keys", forest.trees - 1), ("deeper", forest.trees if before else 0)) for i in range(m)]
    nodes = members.groupBy("key").agg(F.min("t").alias("t"), F.count(F.lit(1)).alias("m"), F.sum("n_sh").alias("size"), F.array(*[(a == b) for a, b in ends]).alias("same"))
    old = F.exists(F.slice("same", forest.trees, forest.trees), lambda x: x) if before else F.lit(False)
    nodes = nodes.filter(~old & ~F.exists(F.slice("same", F.lit(1), F.col("t")), lambda x: x))
    parts = F.greatest(F.ceil(F.col("m") / block), F.ceil(F.col("size") / (block * 4_096))).cast("int")
    nodes = materialize(nodes.select("key", parts.alias("parts")), "forest-nodes")
    dealt = materialize(members.join(_sent(nodes), "key").select("key", "t", "parts", "rid", "keys", "deeper"), "forest-dealt")

    # n-grams only of texts in such nodes, made anew from their rows
    need = materialize(held.join(_sent(materialize(dealt.select("rid").distinct(), "forest-needed")), "rid", "left_semi").select("rid", F.col("doc_id").alias("of_doc"), F.col("th").alias("of_th")), "forest-rows-needed")
    some = docs.join(_sent(need), (F.col("th") == F.col("of_th")) & F.col("doc_id").eqNullSafe(F.col("of_doc"))).select("rid", "text")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = WordHashes()
        for b in batches:
            for i in range(0, b.num_rows, 500):
                x = b.slice(i, 500)
                yield pa.RecordBatch.from_arrays([x.column(0), pa.array([shingles(y.as_py(), seen, n).tobytes() for y in x.column(1)], pa.binary())], names=["rid", "sh"])

    return _compare(dealt.join(some.mapInArrow(lean(sets), "rid long, sh binary"), "rid"), threshold)


def _forest(pairs: np.ndarray, m: int) -> list[tuple[int, int]]:
    """The pairs that connect something new, in order."""
    root = list(range(m))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    out = []
    for i, j in pairs.tolist():
        a, b = top(i), top(j)
        if a != b:
            root[max(a, b)] = min(a, b)
            out.append((i, j))
    return out


def _linked(sets: list[np.ndarray], open_: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i < j, open in the matrix) of sets at or above the threshold, and their similarities."""
    m = len(sets)
    size = np.array([len(s) for s in sets])
    i, j = np.nonzero(np.triu(open_, 1) & (np.minimum(size, size[:, None]) >= threshold * np.maximum(size, size[:, None]) - 1e-9))
    if len(i) <= 8 * m:
        both = np.array([_intersections(sets[a], sets[b]) for a, b in zip(i.tolist(), j.tolist(), strict=True)], int)
    else:  # by matrix products over the n-grams that two sets at least share
        _, ids = np.unique(np.concatenate(sets), return_inverse=True)
        owner = np.repeat(np.arange(m), size)
        keep = np.bincount(ids)[ids] > 1
        ids, column = owner[keep], np.unique(ids[keep], return_inverse=True)[1]
        product = np.zeros((m, m), np.float32)
        for a in range(0, int(column.max(initial=-1)) + 1, 4096):
            at = (column >= a) & (column < a + 4096)
            x = np.zeros((m, 4096), np.float32)
            x[ids[at], column[at] - a] = 1
            product += x @ x.T
        both = product[i, j].astype(int)
    s = both / np.maximum(size[i] + size[j] - both, 1)
    at = s >= threshold - 1e-9
    return np.stack([i[at], j[at]], 1), s[at]


def _compare(members: DataFrame, threshold: float) -> DataFrame:
    """For texts (key, t, parts, rid, keys, deeper, sh) of nodes: (a, null, n, null), how many others are linked to a, by blocks;
    (a, b, null, null), links that connect; (null, null, null, sims), links by similarity. Pairs that share an earlier tree or a deeper prefix are left out."""
    cut = members.withColumn("part", F.pmod(F.xxhash64("rid"), F.col("parts")).cast("int"))
    cut = cut.select("key", "t", "rid", "keys", "deeper", "sh", "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    cut = cut.select("key", F.least("part", "other").alias("p"), F.greatest("part", "other").alias("q"), "part", "rid", "t", "keys", "deeper", "sh")
    cut = cut.repartition("key", "p", "q").sortWithinPartitions("key", "p", "q", "rid")
    out = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64()), ("sims", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        sims = np.zeros(STEPS + 1, np.int64)

        def done() -> pa.RecordBatch:
            side, rid = np.array([h[0] for h in held]), np.array([h[1] for h in held], np.int64)
            keys, t = np.array([h[3] for h in held], np.int64), held[0][2]
            open_ = np.ones((len(held), len(held)), bool)
            if key[1] != key[2]:
                open_ &= side != side[:, None]
            for k in keys.T[:t]:
                open_ &= k != k[:, None]
            for k in np.array([h[4] for h in held], np.int64).T:
                open_ &= k != k[:, None]
            pairs, s = _linked([np.frombuffer(h[5], np.uint64) for h in held], open_, threshold)
            np.add.at(sims, np.minimum((s * STEPS).astype(int), STEPS), 1)
            n = np.bincount(pairs.ravel(), minlength=len(held))
            links = _forest(pairs, len(held))
            some = np.flatnonzero(n)
            a = np.concatenate([rid[some], rid[[i for i, _ in links]]])
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array([None] * len(some) + rid[[j for _, j in links]].tolist(), pa.int64()), pa.array(n[some].tolist() + [None] * len(links), pa.int64()), pa.nulls(len(a), out.field("sims").type)], schema=out)

        for b in batches:
            node, p, q, part, rid, t = (b.column(i).to_pylist() for i in range(6))
            keys, deeper, sh = b.column(6), b.column(7), b.column(8)
            for i in range(b.num_rows):
                if (node[i], p[i], q[i]) != key:
                    if len(held) > 1:
                        yield done()
                    key, held = (node[i], p[i], q[i]), []
                if not held or held[-1][1] != rid[i]:  # rows that are repeated came twice
                    held.append((part[i], rid[i], t[i], keys[i].as_py(), deeper[i].as_py(), sh[i].as_py()))
        if len(held) > 1:
            yield done()
        yield pa.RecordBatch.from_pylist([{"sims": sims.tolist()}], out)

    return cut.mapInArrow(lean(run), "a long, b long, n long, sims array<long>")


def keep_one(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Rows of docs, with all their columns, one of each class: that of the least doc_id (null first), then the least hash of
    its text; all others go. Of rows that repeat both id and text any one stays. Null and empty texts are classes of their
    own, but repeat as others do. Columns may have any names; an empty table stays empty."""
    rows = materialize(join(docs, doc_id=doc_id, text=text, **options).select("rid", "doc_id", "th", "root"), "near-classes")
    best = rows.groupBy("root").agg(F.min(F.struct("doc_id", "th", "rid")).alias("best")).select("best.*")
    id_, hash_ = unused(docs.columns, "doc", "hash")
    named = docs.withColumns({id_: F.col(f"`{doc_id}`").cast("long"), hash_: F.xxhash64(f"`{text}`")})
    columns = [F.col(f"`{c}`") for c in docs.columns]
    if not rows.groupBy("doc_id", "th").count().filter("count > 1").take(1):  # then ids and texts name rows
        gone = materialize(rows.join(best.select("rid"), "rid", "left_anti").select("doc_id", "th"), "near-copies")
        gone = _sent(gone.toDF(*unused([*named.columns], "d", "t")))
        return named.join(gone, named[id_].eqNullSafe(F.col(gone.columns[0])) & (named[hash_] == F.col(gone.columns[1])), "left_anti").select(*columns)
    best = best.select("doc_id", "th").distinct().toDF(*unused([*named.columns], "d", "t"))
    kept = named.join(best, named[id_].eqNullSafe(F.col(best.columns[0])) & (named[hash_] == F.col(best.columns[1])), "left_semi")
    return kept.dropDuplicates([id_, hash_]).select(*columns)


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size", "n_copies", "n_links")
