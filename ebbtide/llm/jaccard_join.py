"""Exact similarity join of documents on word shingles, by a grouped prefix join.

1. Every document becomes the set of its shingle hashes. Equal sets are one class.
2. Shingles are ordered by corpus frequency, rarest first. Two sets with the wanted similarity share a
   shingle in their prefixes (the first n - ceil(t * n) + 1); shingles that occur once need not be
   looked up. A class whose prefix holds only such shingles has no partner and goes no further.
3. Classes with identical prefix and size form a group. Groups that share a prefix shingle are
   candidates, unless their sizes, or the shingles that no other document has, rule the similarity out; their members are expanded and verified.

Links matter only through the classes they connect, so the pairs are taken in two rounds. First every member is
compared with the leader of its group, and the leaders with the leader that is most typical of each shingle: that
needs as many pairs as rows, however large a family of near copies is, and mostly connects it. Then the
candidates that are still in different components are compared, all of them, each pair at the first shingle they
share and only if the sketches of their prefixes allow the similarity.

4. Both ends of a link lie in one component, so links are counted by comparing all classes of a component with each other.
Its classes are dealt into blocks, and each two blocks meet once; a cell of two blocks returns sums per class and no pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.llm import rolling
from ebbtide.llm.common import keep_only, pieces_for, stored
from ebbtide.llm.components import components

NO_ID = -(2**63)
SETS = "doc_id long, id long, hash long, n long, f1 long, f2 long, g1 long, g2 long, rare int, prefix array<long>, sketch array<long>, items binary"
#: Words of 64 bits in the sketch of a prefix, and shingles of a prefix that its later rows carry.
SKETCH, HEAD = 4, 16
#: Classes and shingles in a block of a component, about, and shingles compared at a time.
BLOCK_CLASSES, BLOCK_ITEMS, COLUMNS = 256, 2_000_000, 4096

_blank = np.zeros(256, dtype=bool)
_blank[[32, *range(9, 14)]] = True
_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32


def shingle_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    """Of every text the distinct hashes of `words` consecutive words, rising.

    Words are runs of bytes other than blank and tab to carriage return, with A-Z lower-cased. A text with fewer words has its
    whole sequence as the only element, a text without words none.
    """
    out: list[np.ndarray] = []
    for part in rolling.runs([len(t) for t in texts]):
        own = texts[part]
        data = _lower[np.frombuffer(b" ".join(own) + b" ", dtype=np.uint8)]
        blank = _blank[data]
        edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
        if len(blank) and not blank[0]:
            edge = np.append(0, edge)
        starts, ends = edge[::2], edge[1::2]
        running = rolling.running_hash(data)
        word = rolling.stretch_hash(running, starts, ends)
        size = np.array([len(t) + 1 for t in own])
        cut = np.searchsorted(starts, np.append(0, np.cumsum(size)))
        for a, b in zip(cut[:-1], cut[1:]):
            w = word[a:b]
            wide = min(words, len(w))
            if not wide:
                out.append(w)
                continue
            total = np.full(len(w) - wide + 1, np.uint64(wide), dtype=np.uint64)
            for j in range(wide):
                total = rolling.mix(total + w[j : len(w) - wide + 1 + j])
            out.append(np.unique(total))
    return out


def _sets(table: pa.Table, words: int) -> list[np.ndarray]:
    return shingle_sets([t.encode("utf-8", "replace") for t in table["text"].to_pylist()], words)


def _sender(words: int, buckets: int):
    def send(key: tuple, docs: pa.Table) -> pa.Table:
        keep_only("jaccard_join")
        hashes, counts = np.unique(np.concatenate([np.zeros(0, np.uint64), *_sets(docs, words)]), return_counts=True)
        return rolling.pack(key[0].as_py(), hashes, counts, buckets)

    return send


def _digest(items: np.ndarray, seed: int) -> int:
    """Order-free 64-bit digest of a set."""
    total = np.add.reduce(rolling.mix(items ^ np.uint64(seed)), dtype=np.uint64) if len(items) else np.uint64(0)
    return int(rolling.mix(np.array([total + np.uint64(len(items))]))[0].astype(np.int64))


def _sketch(items: np.ndarray) -> list[int]:
    """A bit per element, by its hash."""
    bits = np.zeros(SKETCH, dtype=np.uint64)
    np.bitwise_or.at(bits, (items >> np.uint64(6)) % np.uint64(SKETCH), np.uint64(1) << (items & np.uint64(63)))
    return bits.astype(np.int64).tolist()


def _prefixer(words: int, percent: int):
    def prefixes(key: tuple, docs: pa.Table, counted: pa.Table) -> pa.Table:
        sets = _sets(docs, words)
        hashes = np.unique(np.concatenate([np.zeros(0, np.uint64), *sets]))
        levels = rolling.unpack(counted)
        rows = {c: [] for c in ("n", "f1", "f2", "g1", "g2", "rare", "prefix", "sketch", "items")}
        for items in sets:
            n = len(items)
            level = levels[np.searchsorted(hashes, items)]
            order = np.lexsort((items, level))
            first = order[: n - -(-n * percent // 100) + 1] if n else order
            shared = items[first][level[first] > 1]
            rare = int((level == 1).sum())
            live = len(shared) > 0
            values = (n, _digest(items, 1), _digest(items, 2), _digest(items[first], 3), _digest(items[first], 4), rare,
                      shared.astype(np.int64) if live else None, _sketch(shared) if live else None, items.tobytes() if live else None)
            for c, v in zip(rows, values):
                rows[c].append(v)
        kinds = {"rare": pa.int32(), "prefix": pa.list_(pa.int64()), "sketch": pa.list_(pa.int64()), "items": pa.binary()}
        return pa.table({"doc_id": docs["doc_id"], "id": docs["id"], "hash": docs["hash"], **{c: pa.array(v, kinds.get(c, pa.int64())) for c, v in rows.items()}})

    return prefixes


def _verify(percent: int):
    def verify(batches):
        for batch in batches:
            left, right = batch["x"].to_pylist(), batch["y"].to_pylist()
            good = np.zeros(len(left), dtype=bool)
            for i, (x, y) in enumerate(zip(left, right)):
                a, b = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                if len(a) > len(b):
                    a, b = b, a
                at = np.minimum(np.searchsorted(b, a), len(b) - 1)
                same = int((b[at] == a).sum())
                good[i] = 100 * same >= percent * (len(a) + len(b) - same)
            yield pa.RecordBatch.from_arrays([batch["a"].filter(pa.array(good)), batch["b"].filter(pa.array(good))], ["a", "b"])

    return verify


def _links(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Of candidate pairs (a, b) of classes those that have the similarity."""
    pairs = pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    items = classes.select(F.col("class").alias("b"), F.col("items").alias("y"))
    full = pairs.join(items, "b").join(items.select(F.col("b").alias("a"), F.col("y").alias("x")), "a")
    return full.select("a", "b", "x", "y").mapInArrow(_verify(percent), "a long, b long")


def _possible(a: str, b: str, percent: int) -> Column:
    """Whether two rows of the lists of one shingle allow the similarity.

    Columns (a + ..., b + ...): n, the size; rare, the number of shingles that no other document has; place, that of the
    shingle among the others in corpus order; indexed, whether the prefix needed towards
    sets that are no smaller holds it. At most least(place) shingles before this one are shared, and what follows it in the
    shorter rest.
    """
    x = lambda side, c: F.col(side + c)
    rest = [x(s, "n") - x(s, "rare") - x(s, "place") for s in (a, b)]
    fits = (F.least(x(a, "place"), x(b, "place")) + F.least(*rest)) * (100 + percent) >= (x(a, "n") + x(b, "n")) * percent
    smaller = F.struct(x(a, "n"), F.col(a)) <= F.struct(x(b, "n"), F.col(b))
    return fits & F.when(smaller, x(a, "indexed")).otherwise(x(b, "indexed"))


def _alike(a: str, b: str, percent: int) -> Column:
    """Whether the whole prefixes of two rows allow the similarity; never false for a similar pair.

    Columns (a + ..., b + ...): n; shared, the number of prefix shingles that other documents have; sketch, a bit for each of
    them. A bit that only one side has is a prefix shingle the other lacks. What is shared lies in both prefixes, or
    behind the prefix that ends first.
    """
    x = lambda side, c: F.col(side + c)
    alone = lambda s, t: sum(F.bit_count(x(s, "sketch")[i].bitwiseAND(F.bitwise_not(x(t, "sketch")[i]))) for i in range(SKETCH))
    common = F.least(x(a, "shared") - alone(a, b), x(b, "shared") - alone(b, a))
    behind = F.greatest(*(F.ceil(x(s, "n") * percent / 100) - 1 for s in (a, b)))
    return (common + behind) * (100 + percent) >= (x(a, "n") + x(b, "n")) * percent


def _shared(sets: list[np.ndarray]) -> np.ndarray:
    """For each two sets how many elements they share."""
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, place, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    several = held[place] > 1
    owner, place = owner[several], (np.cumsum(held > 1) - 1)[place[several]]
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    total = np.zeros((len(sets), len(sets)), dtype=np.int64)
    for begin in range(0, int(place[-1]) + 1 if len(place) else 0, COLUMNS):
        own = slice(*np.searchsorted(place, [begin, begin + COLUMNS]))
        has = np.zeros((len(sets), COLUMNS), dtype=np.float32)  # exact for whole numbers up to 2**24
        has[owner[own], place[own] - begin] = 1
        total += (has @ has.T).astype(np.int64)
    return total


def _cell_counter(percent: int):
    def count(key: tuple, rows: pa.Table) -> pa.Table:
        low, high = key[1].as_py(), key[2].as_py()
        block, weight = rows["block"].to_numpy(), rows["weight"].to_numpy()
        sets = [np.frombuffer(x, dtype=np.uint64) for x in rows["items"].to_pylist()]
        size = np.array([len(x) for x in sets])
        same = _shared(sets)
        linked = 100 * same >= percent * (size[:, None] + size[None, :] - same)
        np.fill_diagonal(linked, False)
        if low != high:
            linked &= block[:, None] != block[None, :]
        return pa.table({"class": rows["class"], "links": pa.array(linked @ weight, pa.int64())})

    return count


def _links_beyond(classes: DataFrame, weights: DataFrame, label: DataFrame, percent: int) -> DataFrame:
    """class, links: how many documents of other classes are similar, for every class that has links."""
    found = classes.select(F.col("class").alias("node"), "f1", "f2", "n", "items").join(label, "node").join(weights, ["f1", "f2"])
    found = stored(found.select(F.col("node").alias("class"), "component", "n", "weight", "items"), "linked")
    blocks = found.groupBy("component").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_CLASSES), F.ceil(F.sum("n") / BLOCK_ITEMS)).cast("int").alias("blocks"))
    dealt = found.join(blocks, "component").withColumn("block", F.pmod(F.xxhash64("class", F.lit(1)), "blocks").cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = dealt.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
    parts = cells.select("component", "low", "high", "class", "block", "weight", "items").groupBy("component", "low", "high").applyInArrow(_cell_counter(percent), "class long, links long")
    return stored(parts.groupBy("class").agg(F.sum("links").alias("links")), "counts")


def similar_documents(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", count_links: bool = True) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id reachable by links, its own included), n_links.

    text_hash, xxhash64 of the text (a missing one as empty), tells apart texts under one id, and component names the component
    also if it has no id; it is missing for documents that share no shingle.
    n_links is the number of other documents it links with; rows of one id and set are one document, each row without an id is
    one of its own. Without `count_links` the column and the work for it are left out.

    Two documents link if 100 * shared shingles >= percent * all their shingles. Missing texts, empty ones and those
    without words have no shingles and link with nothing. Repeated rows (same id) are one node.
    Rows without an id are nodes of their own text's class; a component of only such rows has no id. An empty table gives an
    empty result. Extra columns are ignored. Equality of shingles and sets is decided by 64 and 128 bits of hash.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64(text).alias("hash"), text.alias("text"))
    chunked, _, total = rolling.chunked(source, "id", "text")
    by_chunk = chunked.groupBy("chunk")
    buckets = pieces_for(total / 6, rolling.BUCKET_HASHES)
    packed = by_chunk.applyInArrow(_sender(words, buckets), rolling.PACKED)
    sets = by_chunk.cogroup(rolling.frequencies(packed).groupBy("chunk")).applyInArrow(_prefixer(words, percent), SETS)
    sets = stored(sets, "sets")
    live = sets.where("prefix is not null")
    # equal sets are one class, named by its smallest id; a class without ids by a hash below all ids that are in use
    classes = live.groupBy("f1", "f2").agg(
        F.min(F.when(F.col("doc_id").isNotNull(), F.col("id"))).alias("least"), F.first("n").alias("n"), F.first("g1").alias("g1"),
        F.first("g2").alias("g2"), F.first("rare").alias("rare"), F.first("prefix").alias("prefix"),
        F.first("sketch").alias("sketch"), F.first("items").alias("items"),
    )
    classes = stored(classes.withColumn("class", F.xxhash64("f1", "f2")), "classes")
    typical = F.struct("rare", "class", "n")
    groups = classes.groupBy("g1", "g2", "n").agg(F.min(typical).alias("leader"))
    member = classes.select("class", "n", "rare", "g1", "g2").join(groups, ["g1", "g2", "n"]).select("class", F.col("leader.class").alias("leader"), "n", "rare")
    member = stored(member, "members")
    leaders = classes.join(member.where("class = leader").select("class"), "class").select("class", "n", "rare", F.posexplode("prefix").alias("place", "shingle"))
    short = F.col("n") - F.ceil(F.col("n") * 2 * percent / (100 + percent)) + 1
    listed = stored(leaders.withColumn("indexed", F.col("rare") + F.col("place") < short), "lists")
    heads = listed.groupBy("shingle").agg(F.min(typical).alias("head"))
    first = member.select(F.col("class").alias("a"), F.col("leader").alias("b")).unionByName(
        listed.join(heads, "shingle").where((F.least("n", "head.n") - F.col("rare")) * (100 + percent) >= (F.col("n") + F.col("head.n")) * percent)
        .select(F.col("class").alias("a"), F.col("head.class").alias("b"))
    )
    links = stored(_links(first, classes, percent), "near")
    # candidates that the first round leaves apart
    label = stored(components(links), "labels")
    labelled = member.join(label.withColumnRenamed("node", "class"), "class", "left").withColumn("component", F.coalesce("component", "class"))
    labelled = stored(labelled, "labelled")
    lists = listed.select("shingle", "place", "indexed", F.col("class").alias("leader")).join(labelled.select("leader", "class", "n", "rare", "component"), "leader")
    apart = lists.groupBy("shingle").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("shingle")
    # a row carries the first shingles before its own: a pair that shares one of them is met there
    prefixes = classes.select(F.col("class").alias("leader"), "prefix", "sketch")
    mixed = lists.join(apart, "shingle").join(prefixes, "leader").select(
        "shingle", "place", "indexed", "class", "n", "rare", "component", "sketch", F.size("prefix").alias("shared"),
        F.slice("prefix", F.lit(1), F.least("place", F.lit(HEAD))).alias("head"),
    )
    mixed = stored(mixed, "mixed")
    largest = mixed.groupBy("shingle", "component").agg(F.count(F.lit(1)).alias("c")).groupBy("shingle").agg(F.max(F.struct("c", "component")).alias("top"))
    tagged = mixed.join(largest, "shingle").withColumn("outside", F.col("component") != F.col("top.component"))
    carried = ("n", "rare", "place", "indexed", "component", "sketch", "shared", "head", "outside")
    side = lambda df, x: df.select("shingle", F.col("class").alias(x), *(F.col(c).alias(x + c) for c in carried))
    once = (~F.col("boutside") | (F.col("a") < F.col("b"))) & ~F.arrays_overlap("ahead", "bhead")
    met = (F.col("acomponent") != F.col("bcomponent")) & _possible("a", "b", percent) & _alike("a", "b", percent) & once
    second = side(tagged.where("outside"), "a").join(side(tagged, "b"), "shingle").where(met).select("a", "b")
    links = links.unionByName(_links(second, classes, percent))
    label = stored(components(links).withColumnRenamed("node", "class"), "labels")
    named = classes.select("class", "f1", "f2", "least").join(label, "class", "left").withColumn("component", F.coalesce("component", "class"))
    named = stored(named, "named")
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    found = named.join(smallest, "component").select("class", "f1", "f2", "component", "component_id")
    columns = ["doc_id", F.col("n").alias("n_shingles"), F.when(F.col("live"), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")]
    columns += [F.col("hash").alias("text_hash"), F.when(F.col("live"), F.col("component")).alias("component")]
    if count_links:
        nodes = live.groupBy("f1", "f2", "doc_id").agg(F.count(F.lit(1)).alias("c"))
        weights = stored(nodes.groupBy("f1", "f2").agg(F.sum(F.when(F.col("doc_id").isNull(), F.col("c")).otherwise(1)).alias("weight")), "weights")
        beyond = _links_beyond(classes, weights, label.withColumnRenamed("class", "node"), percent)
        found = found.join(weights, ["f1", "f2"]).join(beyond, "class", "left").withColumn("links", F.col("weight") - 1 + F.coalesce("links", F.lit(0)))
        columns.append(F.when(F.col("live"), F.col("links")).otherwise(0).cast("long").alias("n_links"))
    return sets.select("doc_id", "hash", "n", F.col("prefix").isNotNull().alias("live"), "f1", "f2").join(found, ["f1", "f2"], "left").select(*columns)
