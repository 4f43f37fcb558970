"""Operator 3, n-gram Jaccard join: adaptive multi-match prefixes over word shingles.

A document is the set of hashes of its 5-word shingles; equal sets are one node. With tokens in one global order, rarest
first, two nodes that reach the threshold share at least l tokens of their prefixes of length n - ceil(t n) + l. Each node picks
the l that makes its own cost smallest: a longer prefix costs more postings but lets a partner through only with l shared
prefix tokens (l of the pair is the smaller of the two).

1. Documents are packed into compressed blocks; fingerprints of their sets make the nodes, and one document of each node goes on.
2. Blocks tally their shingles (``blocks.tally``): the order follows the number of nodes that hold a shingle. Shingles of one node take places in
   its prefix but are never sent, nor is a node that has too few others to reach the threshold with anyone.
3. Postings of the prefix tokens are put into clusters by the smallest node that holds the token, so that two nodes with a
   common prefix token meet in a cluster. Within a cluster the shared prefix tokens of all pairs are counted as a product of sparse
   matrices; pairs with l of them, and sizes that fit, are verified on their full sets; a spanning forest of the links comes out.
4. Clusters beyond ``CLUSTER`` nodes are cut into chunks, each with the cluster's leader. Once their links have made components, chunks that
   hold different components meet pair by pair, and only pairs of nodes across components are counted and verified.

So every link lies within a component, and every component is held together by links. Sets have hashes of 64 bits, fingerprints 128.

Defined cases: null text, empty text and text of separators have an empty set and link with nothing; fewer words than a shingle
are one shingle; a null id keeps its row, links like any other and is never a representative; repeated rows share their node; unlike texts that share an
id are documents of their own; an empty table gives an empty result; texts of any length are hashed in parts; other columns are kept
by ``one_of_each`` and not read otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.blocks import COUNTS, ROW_BITS, Block, buckets_of, levels_of, pack, range_bits, rows_of, tally
from corpusloom.llm.common import BASE, Scratch, connected_components, cut, mix64, powers, span_hashes, word_spans

SIZE = 5  # words in a shingle
NUM, DEN = 3, 4  # the threshold as a fraction
MOST_MATCHES = 32
PART = 4 << 20  # bytes of a text that are hashed at once
CLUSTER = 2048  # nodes of a cluster, and
CLUSTER_BYTES = 16 << 20  # bytes of its sets, beyond which it is cut


def _lower(data: np.ndarray) -> np.ndarray:
    low = data.copy()
    low[(low >= 65) & (low <= 90)] += 32
    return low


def _mixed(words: np.ndarray) -> np.ndarray:
    """A hash of each run of ``SIZE`` words."""
    n = len(words) - SIZE + 1
    mixed = np.zeros(max(0, n), np.uint64)
    for k in range(SIZE if n > 0 else 0):
        mixed = (mixed ^ words[k : n + k]) * np.uint64(BASE)
        mixed ^= mixed >> np.uint64(29)
    return mix64(mixed)


def _few(words: np.ndarray) -> np.ndarray:
    """The one shingle of a text of fewer words."""
    h = np.uint64(len(words))
    for w in words:
        h = mix64(np.array([h ^ w], np.uint64))[0]
    return np.array([h] if len(words) else [], np.uint64)


def _long_set(data: np.ndarray, most: int) -> np.ndarray:
    """The set of one long text, a part at a time; words that reach over the end of a part are put together."""
    found, carried = [], np.zeros(0, np.uint64)  # sets of parts, and the last words, which begin the next shingles
    open_sum, open_size, count = 0, 0, 0
    for lo in range(0, len(data), most):
        low = _lower(data[lo : lo + most])
        starts, ends, _ = word_spans(low, np.array([0, len(low)]))
        up, down = powers(len(low) + 1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((low.astype(np.uint64) + np.uint64(1)) * up[: len(low)])])
        value, size = (sums[ends] - sums[starts]) * down[starts], (ends - starts).astype(np.uint64)
        if open_size:
            if len(starts) and starts[0] == 0:
                value[0] = np.uint64((open_sum + pow(BASE, open_size, 1 << 64) * int(value[0])) % (1 << 64))
                size[0] += np.uint64(open_size)
            else:
                value, size, ends = np.r_[np.uint64(open_sum), value], np.r_[np.uint64(open_size), size], np.r_[0, ends]
        open_size = 0
        if len(ends) and ends[-1] == len(low) and lo + most < len(data):
            open_sum, open_size = int(value[-1]), int(size[-1])
            value, size = value[:-1], size[:-1]
        words = np.concatenate([carried, mix64(value ^ size)])
        count += len(value)
        found.append(np.unique(_mixed(words)))
        carried = words[max(0, len(words) - SIZE + 1) :]
    return np.unique(np.concatenate(found)) if count >= SIZE else _few(carried)


def shingle_sets(data: np.ndarray, at: np.ndarray, most: int = PART) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each row."""
    if len(data) > most:
        out, row = [], 0
        while row < len(at) - 1:
            stop = max(row + 1, int(np.searchsorted(at, at[row] + most, "right")) - 1)
            part, sub = data[at[row] : at[stop]], at[row : stop + 1] - at[row]
            out += [_long_set(part, most)] if len(part) > most else shingle_sets(part, sub, most)
            row = stop
        return out
    low = _lower(data)
    starts, ends, rows = word_spans(low, at)
    words = span_hashes(low, starts, ends)
    first = np.searchsorted(rows, np.arange(len(at)))
    mixed, out = _mixed(words), []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        out.append(np.unique(mixed[a : b - SIZE + 1]) if b - a >= SIZE else _few(words[a:b]))
    return out


def prints_of(tokens: np.ndarray) -> tuple[int, int]:
    """128 bits of fingerprint of a set, in two words."""
    size = np.uint64(len(tokens))
    sums = [mix64(tokens ^ np.uint64(seed)).sum(dtype=np.uint64) + size for seed in (0xA24BAED4963EE407, 0x9FB21C651E98DF25)]
    return tuple(int(x) for x in mix64(np.array(sums, np.uint64)).view(np.int64))


def prefix_of(levels: np.ndarray) -> tuple[int, int]:
    """Matches required and prefix length that cost least, from the levels of the tokens in order.

    With l matches required, a prefix that meets p postings admits at most p / l candidates, each verified over
    its whole set.
    """
    n = len(levels)
    need = -(-NUM * n // DEN)
    longest = min(MOST_MATCHES, need)
    lengths = n - need + np.arange(1, longest + 1)
    shared = levels > 1
    posted = np.concatenate([[0], np.cumsum(shared)])[lengths]
    met = np.concatenate([[0.0], np.cumsum(np.where(shared, COUNTS[levels], 0))])[lengths]
    best = int(np.argmin(posted + met / np.arange(1, longest + 1) * n / 40))
    return best + 1, int(lengths[best])


def _facts(data: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    sets = shingle_sets(data, at)
    prints = np.array([prints_of(s) for s in sets], np.int64).reshape(len(sets), 2)
    return [np.array([len(s) for s in sets], np.int64), prints[:, 0].copy(), prints[:, 1].copy()]


def _documents(blocks: DataFrame) -> DataFrame:
    """``doc_id, key, n, first, second, row`` of every document; ``row`` tells its block and its place there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in rows_of(batches):
            ids, keys, n, first, second = (np.frombuffer(r[k], np.int64) for k in ("ids", "keys", "n", "first", "second"))
            row = (r["block"] << ROW_BITS) + np.arange(len(ids))
            yield pa.RecordBatch.from_arrays([pa.array(ids, mask=~np.frombuffer(r["known"], bool)), *(pa.array(x) for x in (keys, n, first, second, row))], ["doc_id", "key", "n", "first", "second", "row"])

    return blocks.select("block", "ids", "known", "keys", "n", "first", "second").mapInArrow(run, "doc_id long, key long, n long, first long, second long, row long")


def _chosen_sets(row: dict) -> tuple[np.ndarray, list[np.ndarray]]:
    """The rows of a block that stand for their nodes, and their sets."""
    block, rows = Block(row), np.sort(np.array(row["rows"], np.int64))
    if len(rows) == len(block.ids):
        return rows, shingle_sets(block.data, block.at)
    sizes = block.at[rows + 1] - block.at[rows]
    data = np.concatenate([block.data[block.at[r] : block.at[r + 1]] for r in rows])
    return rows, shingle_sets(data, np.concatenate([[0], np.cumsum(sizes)]))


def _hashes(row: dict) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(np.concatenate(_chosen_sets(row)[1]), return_counts=True)


def _records(levelled: DataFrame) -> DataFrame:
    """``node, n, matches, prefix, rest`` of each node that may have a partner: the tokens of its prefix and of its set that other nodes have too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            rows, sets = _chosen_sets(row)
            values, levels = np.unique(np.concatenate(sets)), levels_of(row)
            out = []
            for r, s in zip(rows.tolist(), sets, strict=True):
                seen = levels[np.searchsorted(values, s)]
                rest = s[seen > 1]
                if DEN * len(rest) < NUM * len(s):
                    continue
                order = np.lexsort((s, seen))
                matches, length = prefix_of(seen[order])
                prefix = order[:length][seen[order[:length]] > 1]
                if len(prefix):
                    out.append(((row["block"] << ROW_BITS) + r, len(s), matches, s[prefix].view(np.int64), rest.tobytes()))
            if out:
                at = np.concatenate([[0], np.cumsum([len(x[3]) for x in out])]).astype(np.int32)
                prefixes = pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate([x[3] for x in out])))
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()), pa.array([x[2] for x in out], pa.int64()), prefixes, pa.array([x[4] for x in out], pa.binary())], ["node", "n", "matches", "prefix", "rest"])

    return levelled.mapInArrow(run, "node long, n long, matches long, prefix array<long>, rest binary")


def _common(tokens: list[np.ndarray]) -> np.ndarray:
    """How many tokens each two of the sets share, as a matrix."""
    m = len(tokens)
    row = np.repeat(np.arange(m), [len(t) for t in tokens])
    _, column, count = np.unique(np.concatenate(tokens), return_inverse=True, return_counts=True)
    shared = count > 1
    keep = shared[column]
    row, column = row[keep], (np.cumsum(shared) - 1)[column[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    width, total = max(64, (1 << 22) // m), int(shared.sum())
    kind = np.float32 if max(map(len, tokens)) < 1 << 24 else np.float64
    out = np.zeros((m, m), kind)
    for lo in range(0, total, width):
        a, b = np.searchsorted(column, [lo, lo + width])
        part = np.zeros((m, min(width, total - lo)), kind)
        part[row[a:b], column[a:b] - lo] = 1
        out += part @ part.T
    return out


def cluster_links(nodes: np.ndarray, n: np.ndarray, matches: np.ndarray, own: np.ndarray, prefixes: list[np.ndarray], rests: list[np.ndarray]) -> list[tuple[int, int]]:
    """A spanning forest of the links between nodes of different ``own``."""
    fits = (own[:, None] != own) & (DEN * np.minimum(n[:, None], n) >= NUM * np.maximum(n[:, None], n))
    fits &= _common(prefixes) >= np.minimum(matches[:, None], matches)
    use = np.flatnonzero(fits.any(axis=1))
    if len(use) < 2:
        return []
    common = _common([rests[k] for k in use])
    links = fits[np.ix_(use, use)] & (DEN * common >= NUM * (n[use][:, None] + n[use] - common))
    label, out = np.arange(len(use)), []
    for r in np.flatnonzero(links.any(axis=1)):
        met = np.flatnonzero(links[r])
        names, first = np.unique(label[met], return_index=True)
        other = names != label[r]
        out += [(int(nodes[use[r]]), int(nodes[use[met[k]]])) for k in first[other]]
        if other.any():
            least = min(label[r], names[0])
            label[np.isin(label, names) | (label == label[r])] = least
    return out


def _forests(members: DataFrame) -> DataFrame:
    """Links ``(a, b)`` within each group of ``cluster, node, n, matches, prefix, rest, own``."""

    def solved(held: list[pa.RecordBatch]) -> list[tuple[int, int]]:
        if sum(b.num_rows for b in held) < 2:
            return []
        nodes, n, matches, own = (np.concatenate([b.column(k).to_numpy() for b in held]) for k in (1, 2, 3, 6))
        prefixes = [x.values.to_numpy().view(np.uint64) for b in held for x in b.column(4)]
        rests = [np.frombuffer(x.as_py(), np.uint64) for b in held for x in b.column(5)]
        return cluster_links(nodes, n, matches, own, prefixes, rests)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = [], None
        for batch in batches:
            found, clusters = [], batch.column(0).to_numpy()
            heads = np.flatnonzero(np.diff(clusters, prepend=clusters[:1] - 1)) if len(clusters) else []
            for a, b in zip(heads, np.append(heads[1:], len(clusters)), strict=True) if len(clusters) else ():
                if clusters[a] != key:
                    found += solved(held)
                    held, key = [], clusters[a]
                held.append(batch.slice(a, b - a))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["a", "b"])
        if found := solved(held):
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["a", "b"])

    ordered = members.select("cluster", "node", "n", "matches", "prefix", "rest", "own").repartition("cluster").sortWithinPartitions("cluster")
    return ordered.mapInArrow(run, "a long, b long")


def _parts(count: Column, size: Column, nodes: int, bytes_: int) -> Column:
    return F.greatest(F.lit(1), F.ceil(count / nodes), F.ceil(size / bytes_))


def _links(records: DataFrame, most: int, most_bytes: int) -> DataFrame:
    """The links that make the components, ``(a, b)`` by node."""
    postings = records.select("node", F.explode("prefix").alias("token"))
    leads = postings.groupBy("token").agg(F.min("node").alias("lead"), F.count("*").alias("c")).where("c > 1").select("token", "lead")
    members = cut(postings.join(leads, "token").select("lead", "node").distinct())
    sized = members.join(records.select("node", (F.octet_length("rest") + 8 * F.size("prefix")).alias("size")), "node")
    clusters = sized.groupBy("lead").agg(F.count("*").alias("c"), F.sum("size").alias("s"))
    clusters = cut(clusters.select("lead", _parts(F.col("c"), F.col("s"), most, most_bytes).alias("parts")))
    part = F.when(F.col("lead") == F.col("node"), F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).otherwise(F.array(F.pmod(F.xxhash64("node"), "parts")))
    placed = members.join(clusters, "lead").select("lead", "node", F.explode(part).alias("part"))
    first = placed.join(records, "node").withColumn("cluster", F.xxhash64("lead", "part")).withColumn("own", F.col("node"))
    links = cut(_forests(first))
    large = clusters.where("parts > 1").select("lead")
    if large.isEmpty():
        return links

    # chunks of large clusters: those of one component each, and those of what is left
    label = connected_components(links).withColumnRenamed("component", "known")
    crowd = sized.join(large, "lead").join(label, "node", "left").select("lead", "node", "size", F.coalesce("known", "node").alias("own"))
    crowd = cut(crowd)
    by = crowd.groupBy("lead", "own").agg(F.count("*").alias("c"), F.sum("size").alias("s"))
    by = by.withColumn("alone", (F.col("c") * 4 >= most) | (F.col("s") * 4 >= most_bytes))
    kind = F.when(F.col("alone"), F.col("own")).otherwise(F.lit(-1))
    named = by.select("lead", "own", kind.alias("kind"))
    chunks = by.groupBy("lead", kind.alias("kind")).agg(F.sum("c").alias("c"), F.sum("s").alias("s"))
    chunks = chunks.select("lead", "kind", _parts(F.col("c"), F.col("s"), most // 2, most_bytes // 2).alias("parts"))
    each = cut(chunks.select("lead", "kind", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part")))
    left, right = (each.select("lead", F.struct("kind", "part").alias(side)) for side in "xy")
    pairs = left.join(right, "lead").where("x.kind < y.kind or (x.kind = -1 and y.kind = -1 and x.part <= y.part)")
    tiles = pairs.select("lead", F.xxhash64("lead", "x", "y").alias("cluster"), F.explode(F.array_distinct(F.array("x", "y"))).alias("c")).select("lead", "cluster", "c.kind", "c.part")
    crowd = crowd.join(named, ["lead", "own"]).join(chunks, ["lead", "kind"]).withColumn("part", F.pmod(F.xxhash64("node"), "parts"))
    tiled = crowd.select("lead", "kind", "part", "node", "own").join(tiles, ["lead", "kind", "part"]).select("cluster", "node", "own").join(records, "node")
    return cut(links.unionByName(_forests(tiled)))


def _key(docs: DataFrame, id_col: str, text_col: str) -> Column:
    """A hash of id and text, by which a document is found again; never null, whatever the id."""
    return F.xxhash64(docs[id_col].cast("long"), docs[text_col].cast("string"))


def _grouped(docs: DataFrame, id_col: str, text_col: str, most: int, most_bytes: int) -> DataFrame:
    """``doc_id, key, n_shingles, component, component_id`` for every document; ``component`` is a node, so groups of one id stay apart."""
    scratch = Scratch(docs.sparkSession)
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"), _key(docs, id_col, text_col).alias("key"))
    blocks = scratch.bucketed(pack(rows, _facts, ("n", "first", "second")), buckets_of(rows, "text")[0], "block")
    prints = _documents(blocks)
    classes = cut(prints.where("n > 0").groupBy("first", "second").agg(F.min("row").alias("node"), F.min("doc_id").alias("doc_id"), F.first("n").alias("n")))
    tokens = classes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    row = F.col("node").bitwiseAND((1 << ROW_BITS) - 1).cast("int")
    chosen = classes.groupBy(F.shiftright("node", ROW_BITS).alias("block")).agg(F.collect_list(row).alias("rows"))
    own = blocks.drop("n", "first", "second").join(chosen.hint("shuffle_hash"), "block")
    levelled = own.join(tally(own, _hashes, range_bits(tokens)).hint("shuffle_hash"), "block")
    records = scratch.table(_records(levelled))
    label = connected_components(_links(records, most, most_bytes))
    named = classes.join(label, "node", "left").select("first", "second", "doc_id", F.coalesce("component", "node").alias("component"))
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = named.join(least, "component").select("first", "second", "component", "component_id")
    out = prints.join(named, ["first", "second"], "left")
    out = cut(out.select("doc_id", "key", F.col("n").alias("n_shingles"), F.coalesce("component", F.lit(-1)).alias("component"), F.coalesce("component_id", "doc_id").alias("component_id")))
    scratch.clear()
    return out


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = CLUSTER, most_bytes: int = CLUSTER_BYTES) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every document."""
    return _grouped(docs, id_col, text_col, most, most_bytes).select("doc_id", "n_shingles", "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The document with the smallest id of each group, all columns kept; rows without an id stay.

    Where several documents of a group share that id, hashes of their text and columns choose, whatever the partitions.
    """
    columns = [f"c{i}" for i in range(len(docs.columns))]
    col = {name: columns[i] for i, name in reversed(list(enumerate(docs.columns)))}
    id_, text = col[id_col], col[text_col]
    rows = docs.toDF(*columns)
    groups = _grouped(rows, id_, text, CLUSTER, CLUSTER_BYTES)
    keep = groups.where("doc_id = component_id").groupBy(F.col("doc_id").alias("kept_id"), "component").agg(F.min("key").alias("kept_key")).drop("component")
    kept = rows.join(keep, (rows[id_] == keep.kept_id) & (_key(rows, id_, text) == keep.kept_key))
    order = F.xxhash64(*(rows[c] for c, kind in rows.dtypes if "map<" not in kind and "variant" not in kind))
    nth = F.row_number().over(Window.partitionBy("kept_id", "kept_key").orderBy(order))
    kept = kept.withColumn("kept_nth", nth).where("kept_nth = 1").drop("kept_id", "kept_key", "kept_nth")
    return kept.unionByName(rows.where(rows[id_].isNull())).toDF(*docs.columns)
