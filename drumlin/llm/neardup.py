"""Near-duplicates by BagMinHash over five-word shingles.

A text is a multiset of shingles of five words (lower case, cut at white space; a text of fewer
words is one shingle). BagMinHash: the weight axis of a shingle is cut into dyadic intervals
[0, 1), [1, 2), [2, 4), ...; each has a Poisson process of points, seeded by shingle and interval,
and only points below the shingle's weight count, those of an interval cut by the weight being told
apart by halving. A point falls into one register of the signature, which keeps the earliest, so
two registers agree with probability equal to the weighted Jaccard similarity. A process stops once
it is later than every register. Bands of equal registers make candidates; the overlap of the two
multisets decides: a link is a similarity of 0.8 or more. Classes are connected by links.

Equal texts are one node. Every text is first verified against the best-looking one of its bands'
leaders. Within bands that still hold more than one component, texts of different components are
compared by signature, in tiles, and a tile hands on the texts that look like one of another component,
never pairs. Those meet once more with all their shingles: a tile counts the shingles its texts share,
and hands on links that connect it, fewer than it has texts. A pair of similarity 0.8 can be missed in
two ways: it shares no band once in 300,000, and fewer than 56 of its 96 registers (``LIKELY``) agree
once in 2,800,000, so that it may never be verified. Shingles are 64-bit hashes: two of a pair are taken
for one with probability below 1e-9 even if the texts have 100,000 words.

Results for edge cases: a null text, or one without a word, is alone in its class; classes are
named by their least doc_id; repeated rows get the same class; with no rows there are no classes.
A name tells classes apart only if ids do: classes without an id have none, and of an id with two
texts two classes may have it. Deduplication goes by the classes themselves and keeps one of each.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drumlin.llm.common import batches_of, chunks, staged, strings, tidy, unused

SHINGLE = 5
SIMILAR = 0.8
BANDS, ROWS = 24, 4
REGISTERS = BANDS * ROWS
#: Share of equal registers from which a pair is worth a look: over five standard errors below SIMILAR.
LIKELY = 0.58
#: Texts, and shingles, of half a tile: what a worker holds of a band at once.
TILE = 2048
TILE_ITEMS = 1_000_000
#: Texts that a worker is handed at once.
BATCH = 2048
#: Rows of a tile whose shared shingles are counted at once, and shingles per matrix product.
BLOCK = 512

GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that looks random."""
    with np.errstate(over="ignore"):
        x = x + GOLDEN
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def uniform(x: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1]."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1) / 2.0**53


def bags(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, hash and weight of each text's distinct shingles."""
    words = [x.lower().split() for x in texts]
    sizes = np.array([len(x) for x in words], np.int64)
    n = int(sizes.sum())
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    codes, known = pd.factorize(np.array([w for x in words for w in x], dtype=object))
    h = np.append(pd.util.hash_array(known, categorize=False)[codes], np.zeros(SHINGLE, np.uint64))
    doc = np.repeat(np.arange(len(texts)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(n)  # words up to the text's end
    short = sizes[doc] < SHINGLE
    first = np.flatnonzero((left >= SHINGLE) | short & (left == sizes[doc]))
    s = np.zeros(len(first), np.uint64)
    with np.errstate(over="ignore"):
        for i in range(SHINGLE):
            there = left[first] > i
            s = mix(s * np.uint64(31) + np.where(there, h[first + i], np.uint64(i + 1)))
        own = mix(s ^ mix(doc[first].astype(np.uint64)))
    number, _ = pd.factorize(own)
    new = ~pd.Series(number).duplicated().to_numpy()
    return doc[first][new], s[new], np.bincount(number)


def items(texts: list[str]) -> list[np.ndarray]:
    """Each text's multiset as a set of hashes: the k-th time a shingle comes is an item of its own."""
    doc, shingle, weight = bags(texts)
    again = np.arange(weight.sum()) - np.repeat(np.cumsum(weight) - weight, weight)
    with np.errstate(over="ignore"):
        every = mix(np.repeat(shingle, weight) + again.astype(np.uint64) * GOLDEN).view(np.int64)
    ends = np.cumsum(np.bincount(np.repeat(doc, weight), minlength=len(texts)))
    return np.split(every, ends[:-1]) if len(texts) else []


def signatures(n: int, doc: np.ndarray, shingle: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Earliest point in each register, (texts, REGISTERS); infinite for texts without a shingle."""
    found = np.full(n * REGISTERS, np.inf)
    # One process for each interval [low, high) that begins below the weight.
    docs, seeds, lows, highs, most = [], [], [], [], []
    low, high = 0, 1
    while (at := np.flatnonzero(weight > low)).size:
        docs.append(doc[at])
        with np.errstate(over="ignore"):
            seeds.append(mix(shingle[at] + np.uint64(high) * np.uint64(0xD6E8FEB86659FD93)))
        lows.append(np.full(len(at), low))
        highs.append(np.full(len(at), high))
        most.append(weight[at])
        low, high = high, max(2, 2 * high)
    if not docs:
        return found.reshape(n, REGISTERS)
    doc, seed = np.concatenate(docs), np.concatenate(seeds)
    low, high, weight = np.concatenate(lows), np.concatenate(highs), np.concatenate(most)
    time = np.zeros(len(doc))
    step = 0
    while len(doc):
        with np.errstate(over="ignore"):
            point = mix(seed + np.uint64(step) * GOLDEN)
        time = time - np.log(uniform(point)) / (high - low)
        register = mix(point)
        place = low + (high - low) * (1 - uniform(mix(register)))  # halving, all digits at once
        counts = place < weight
        at = doc * REGISTERS + (register % np.uint64(REGISTERS)).astype(np.int64)
        np.minimum.at(found, at[counts], time[counts])
        step += 1
        texts, where = np.unique(doc, return_inverse=True) if step > 4 else (np.arange(n), doc)
        latest = found.reshape(n, REGISTERS)[texts].max(axis=1)
        open_ = time <= latest[where]
        doc, seed, low, high, weight, time = (x[open_] for x in (doc, seed, low, high, weight, time))
    return found.reshape(n, REGISTERS)


def band_hashes(times: np.ndarray) -> np.ndarray:
    """A hash of each band's registers, (texts, BANDS)."""
    bits = times.view(np.uint64).reshape(len(times), BANDS, ROWS)
    out = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), bits.shape[:2])
    for i in range(ROWS):
        out = mix(out ^ bits[:, :, i])
    return out.view(np.int64)


def short_signatures(times: np.ndarray) -> np.ndarray:
    return (mix(times.view(np.uint64)) >> np.uint64(48)).astype(np.uint16)


def similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard similarity of two multisets."""
    least = sum((a & b).values())
    return least / (sum(a.values()) + sum(b.values()) - least) if least else 0.0


def bag(text: str) -> Counter:
    words = text.lower().split()
    if len(words) < SHINGLE:
        return Counter([tuple(words)] if words else [])
    return Counter(zip(*[words[i:] for i in range(SHINGLE)], strict=False))


def node(text: Column) -> Column:
    """Equal texts are one node."""
    return F.xxhash64(text)


def signed(docs: DataFrame) -> DataFrame:
    """node, bands, sig and size (its shingles) of each distinct text with a word."""
    rows = docs.where("text is not null").select(node(F.col("text")).alias("node"), "text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch.drop_duplicates("node")
            texts = strings(batch["text"])
            for start, end in chunks(texts, 2_000_000):
                part = texts[start:end]
                doc, shingle, weight = bags(part)
                times = signatures(len(part), doc, shingle, weight)
                there = np.isfinite(times[:, 0]) | np.isfinite(times).any(axis=1)
                if not there.any():
                    continue
                times = np.ascontiguousarray(times[there])
                yield pd.DataFrame(
                    {
                        "node": batch["node"].to_numpy()[start:end][there],
                        "bands": list(band_hashes(times)),
                        "sig": [x.tobytes() for x in short_signatures(times)],
                        "size": np.bincount(doc, weight, len(part))[there].astype(np.int64),
                    }
                )

    return rows.mapInPandas(tidy(run), "node long, bands array<long>, sig binary, size long").dropDuplicates(["node"])


def _likeness(pairs: DataFrame, sigs: DataFrame) -> DataFrame:
    """Adds ``like``: the share of equal registers of a and b."""
    both = pairs.join(sigs.select(F.col("node").alias("a"), F.col("sig").alias("sig_a")), "a").join(
        sigs.select(F.col("node").alias("b"), F.col("sig").alias("sig_b")), "b"
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                x, y = (np.frombuffer(b"".join(batch[c]), np.uint16).reshape(len(batch), REGISTERS) for c in ("sig_a", "sig_b"))
                yield batch[["a", "b"]].assign(like=(x == y).mean(axis=1))

    return both.mapInPandas(tidy(run), "a long, b long, like double")


def itemised(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """node and items of the texts of wanted nodes. Equal texts become one before, as items are neither sorted nor moved."""
    texts = docs.where("text is not null").select(node(F.col("text")).alias("node"), "text")
    texts = texts.dropDuplicates(["node"]).join(wanted, "node", "left_semi")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = strings(batch["text"])
            for start, end in chunks(texts, 2_000_000):
                yield pd.DataFrame({"node": batch["node"].to_numpy()[start:end], "items": items(texts[start:end])})

    return texts.mapInPandas(tidy(run), "node long, items array<long>")


def verified(pairs: DataFrame, bags: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose multisets of shingles have the similarity."""
    # Many pairs share their a, few their b: joined last, it deals them out evenly.
    both = pairs.join(bags.select(F.col("node").alias("a"), F.col("items").alias("x")), "a").join(
        bags.select(F.col("node").alias("b"), F.col("items").alias("y")), "b"
    )
    same = F.size(F.array_intersect("x", "y"))
    return both.where(same / (F.size("x") + F.size("y") - same) >= SIMILAR).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """node, component (its least node) of all nodes with a link, by large and small stars."""
    edges = staged(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc")
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        edges = staged(small.where("u <> v").distinct(), "cc")
        now = tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first())
        if now == before:
            break
        before = now
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(stars.select(F.col("component").alias("node"), "component").distinct())


def _alike(rows: pd.DataFrame) -> pd.DataFrame:
    """Of whole tiles, the rows that look like one of another component."""
    rows = rows.sort_values(["tile", "node"], kind="stable")
    x = np.frombuffer(b"".join(rows["sig"]), np.uint16).reshape(len(rows), REGISTERS)
    tile, part, cut, wide = (rows[c].to_numpy() for c in ("tile", "part", "cut", "wide"))
    like = np.zeros(len(rows), bool)
    for step in range(1, len(rows)):  # every row against the one so many places on in its tile
        there = np.flatnonzero(tile[step:] == tile[:-step])
        if not len(there):
            break
        there = there[~(like[there] & like[there + step])]  # both are known to go on
        on = there + step
        fit = (part[there] != part[on]) & (~wide[there] | (cut[there] != cut[on]))
        there, on = there[fit], on[fit]
        likely = (x[there] == x[on]).mean(axis=1) >= LIKELY
        like[there[likely]] = like[on[likely]] = True
    return rows[like].drop(columns="sig")


def shared_items(bags: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
    """How many items each bag shares with every other, in blocks of rows from a first one."""
    n = len(bags)
    owner = np.repeat(np.arange(n), [len(x) for x in bags])
    _, item, often = np.unique(np.concatenate(bags), return_inverse=True, return_counts=True)
    # Items of many bags by matrix products, of few by lists of their bags; of one bag not at all.
    many = often > max(1, n // 8)
    column = np.cumsum(many) - 1
    on = many[item]
    wide_row, wide_column = owner[on], column[item[on]]
    by_column = np.argsort(wide_column, kind="stable")
    wide_row, wide_column = wide_row[by_column], wide_column[by_column]
    few = ~on & (often[item] > 1)
    row, item = owner[few], item[few]
    order = np.argsort(item, kind="stable")
    holders = row[order]
    first = np.searchsorted(item[order], item)
    ends = np.searchsorted(row, np.arange(n + 1))
    for start in range(0, n, BLOCK):
        end = min(n, start + BLOCK)
        counts = np.zeros((end - start, n))
        for low in range(0, int(many.sum()), BLOCK):
            a, z = np.searchsorted(wide_column, [low, low + BLOCK])
            there = np.zeros((n, BLOCK), np.float32)
            there[wide_row[a:z], wide_column[a:z] - low] = 1
            counts += there[start:end] @ there.T
        for i in range(start, end):
            mine = slice(ends[i], ends[i + 1])
            length = often_of = often[item[mine]]
            if len(often_of):
                at = np.repeat(first[mine] - (np.cumsum(length) - length), length) + np.arange(length.sum())
                counts[i - start] += np.bincount(holders[at], minlength=n)
        yield start, counts


def forest(near: np.ndarray) -> tuple[list[int], list[int]]:
    """Pairs that connect what the symmetric matrix connects, fewer than it has rows."""
    new, a, b = np.ones(len(near), bool), [], []
    for root in range(len(near)):
        open_ = [root] if new[root] else []
        new[root] = False
        while open_:
            i = open_.pop()
            found = np.flatnonzero(near[i] & new)
            new[found] = False
            a += [i] * len(found)
            b += found.tolist()
            open_ += found.tolist()
    return a, b


def _linked(rows: pd.DataFrame) -> pd.DataFrame:
    """Links that connect whole tiles."""
    out = []
    for _, tile in rows.groupby("tile", sort=False):
        node, part, size = tile["node"].to_numpy(), tile["part"].to_numpy(), tile["items"].str.len().to_numpy()
        near = np.zeros((len(tile), len(tile)), bool)
        for start, same in shared_items(list(tile["items"])):
            end = start + len(same)
            near[start:end] = (same / (size[start:end, None] + size - same) >= SIMILAR) & (part[start:end, None] != part)
        a, b = forest(near)
        out.append(pd.DataFrame({"a": node[a], "b": node[b]}))
    return pd.concat(out)


def _by_tile(rows: DataFrame, work: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Work on whole tiles, one after the other."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            if not len(batch):
                continue
            open_ = (batch["tile"] == batch["tile"].iloc[-1]).to_numpy()
            if held and (not open_.all() or held[-1]["tile"].iloc[-1] != batch["tile"].iloc[-1]):
                yield work(pd.concat([*held, batch[~open_]], ignore_index=True))
                held = []
            elif not open_.all():
                yield work(batch[~open_])
            held.append(batch[open_])
        if held:
            yield work(pd.concat(held, ignore_index=True))

    return rows.repartition("tile").sortWithinPartitions("tile").mapInPandas(tidy(run), schema)


def across(bands: DataFrame, nodes: DataFrame, bags: DataFrame, parts: DataFrame) -> DataFrame:
    """Links (a, b) that connect what shares a band, looks alike and is in different components."""
    placed = bands.join(nodes.select("node", "size"), "node").join(parts, "node", "left").select(
        "band", "node", "size", F.coalesce("component", "node").alias("part")
    )
    sizes = (
        placed.groupBy("band")
        .agg(
            F.greatest(F.count("*") / TILE, F.sum("size") / TILE_ITEMS).alias("n"),
            F.min("part").alias("low"),
            F.max("part").alias("high"),
            F.bit_xor(F.xxhash64("node")).alias("who"),
            F.bit_xor(F.xxhash64("node", F.lit(1))).alias("who2"),
        )
        .where("low < high")
    )
    # Bands with the same nodes need one look.
    sizes = sizes.groupBy("n", "who", "who2").agg(F.min("band").alias("band")).select(
        "band", F.ceil("n").cast("int").alias("cuts")
    )
    tiles = (
        placed.join(sizes, "band")
        .withColumn("cut", F.pmod(F.xxhash64("node", F.lit(9)), F.col("cuts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
        .select(
            F.xxhash64("band", F.least("cut", "other"), F.greatest("cut", "other")).alias("tile"),
            "node", "part", "cut", (F.col("cut") != F.col("other")).alias("wide"),
        )
        .join(nodes.select("node", "sig"), "node")
    )
    # A tile of two cuts compares across them only (wide); one of a single cut compares all.
    alike = _by_tile(tiles, _alike, "tile long, node long, part long, cut int, wide boolean")
    alike = staged(alike.select("tile", "node", "part"), "bag-alike")
    return _by_tile(alike.join(bags, "node"), _linked, "a long, b long")


def connected(docs: DataFrame) -> DataFrame:
    """node, component of all nodes with a link."""
    with batches_of(docs.sparkSession, BATCH):
        return _connected(docs)


def _connected(docs: DataFrame) -> DataFrame:
    nodes = staged(signed(docs), "bag-nodes")
    sigs = nodes.select("node", "sig")
    bands = nodes.select("node", F.explode("bands").alias("band"))
    shared = bands.groupBy("band").agg(F.min("node").alias("a"), F.max("node").alias("z")).where("a < z").select("band", "a")
    shared = staged(bands.join(shared, "band"), "bag-shared")  # members of bands with two nodes or more
    bags = staged(itemised(docs, shared.select("node").distinct()), "bag-items")
    pairs = shared.where("a <> node").select("a", F.col("node").alias("b")).distinct()
    best = _likeness(pairs, sigs).where(F.col("like") >= LIKELY).groupBy("b").agg(F.max_by("a", F.struct("like", "a")).alias("a"))
    parts = staged(components(verified(best, bags)), "bag-parts")
    more = staged(across(shared.select("band", "node"), nodes, bags, parts), "bag-links")
    # Components of components: what is connected already is one node.
    part = parts.withColumnRenamed("component", "part")
    for end in ("a", "b"):
        more = more.join(part.withColumnRenamed("node", end), end, "left").withColumn(end, F.coalesce("part", end)).drop("part")
    wider = staged(components(more), "bag-wider")
    into = wider.select(F.col("node").alias("component"), F.col("component").alias("top"))
    joined = parts.join(into, "component", "left").select("node", F.coalesce("top", "component").alias("component"))
    return joined.unionByName(wider.join(parts, "node", "left_anti"))


def wordless(text: Column) -> Column:
    return F.coalesce(F.trim(F.translate(text, "\t\n\r\x0b\x0c", "     ")) == "", F.lit(True))


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, node, part (the class itself; null if alone), class_id (its least doc_id) and class_size of every row."""
    found = staged(connected(docs), "bag-classes")
    # A text without a word, or null, is alone: its node is its row.
    rows = docs.select("doc_id", node(F.col("text")).alias("node"), wordless(F.col("text")).alias("alone"))
    named = rows.join(found, "node", "left").withColumn("part", F.when(~F.col("alone"), F.coalesce("component", "node")))
    named = staged(named.select("doc_id", "node", "part"), "bag-rows")
    least = named.where("part is not null").groupBy("part").agg(
        F.min("doc_id").alias("least"), F.count("*").alias("size")
    )
    return named.join(least, "part", "left").select(
        "doc_id",
        "node",
        "part",
        F.when(F.col("part").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("class_id"),
        F.coalesce("size", F.lit(1)).alias("class_size"),
    )


def registered(docs: DataFrame) -> DataFrame:
    return classes(docs.select("doc_id", "text")).select("doc_id", "class_id", "class_size")


def deduplicate(docs: DataFrame) -> DataFrame:
    """The rows of one document of each class: the one with the least doc_id. Rows that are alone all
    stay, but for repeated ones of an id."""
    found = classes(docs.select("doc_id", "text"))
    first = found.where(F.col("part").isNotNull() & F.col("doc_id").eqNullSafe(F.col("class_id")))
    held = first.groupBy("part").agg(F.min("doc_id").alias("_doc"), F.min("node").alias("_node")).drop("part")
    key, alone = unused("_key", docs.columns), wordless(F.col("text"))
    rows = docs.withColumn(key, node(F.col("text")))
    kept = rows.where(~alone).join(held, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col(key) == F.col("_node")), "left_semi")
    lone = rows.where(alone)
    once = kept.unionByName(lone.where("doc_id is not null")).dropDuplicates(["doc_id", key])
    return once.unionByName(lone.where("doc_id is null")).drop(key)
