"""Phrase collocations, counted by HAT-tries.

A text is lower-cased (A to Z), cut into pieces at ``.,;:!?`` and line ends, and those into words at
blanks and tabs. Phrases of up to ``longest`` words are counted per language, over all
texts: words, then pairs, then longer ones. A phrase can be frequent only if its words and pairs are:
frequent ones set bits of a filter of fixed size, by hash, and the next passes skip phrases with a word or pair that
has no bit. A filter that fills up skips less, and never a frequent phrase.

Each task counts in a HAT-trie: nodes by word id near the root, and below them hash containers of
the rest of the phrase; one that grows too large bursts into containers by its next word. Beyond a
number of entries the largest subtrees are spilled whole, each as a run in order of phrase. Runs meet in the
partition of their prefix, the first word, where Spark merges them. The subtree of a hot word, which is a
share of its language or more, is dealt over many slots by the rest of the phrase; single words are by hash.

Scores are decimals of 38 digits, so nothing is rounded. A longer candidate takes out the ones
inside it that are no more frequent than itself; by steps of one word, since whatever stands between a
phrase and a longer one is as frequent as both.

Results for edge cases: a null text is empty, a null language is ``und``; texts without a word and
languages without a candidate give no row; repeated rows count each time; ties go by phrase; other
columns are not read. Long texts are handled in parts cut between pieces; one piece has to fit into
memory.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drumlin.llm.common import chunks, staged, strings
from drumlin.llm.neardup import mix

LONGEST = 5
LEAST = 100
BEST = 2000
UNKNOWN = "und"
#: Bytes of text handled at once.
PART = 2_000_000
#: Entries of a run, if a subtree has no more.
RUN = 50_000
SALTS = 64
#: Share of a language's words from which a word is hot; slots of a hot word's phrases, and of single words.
HOT = 1e-3
HOT_SLOTS, WORD_SLOTS = 64, 1024


@dataclass(frozen=True)
class Sizes:
    """Entries of a container that bursts, entries of all of a task's containers, and bits of a filter (8 MB)."""

    burst: int = 4096
    entries: int = 600_000
    bits: int = 1 << 26


#: One byte to one byte: capitals to small letters, separators to line ends, tabs to blanks.
TABLE = bytes(
    c + 32 if 65 <= c <= 90 else 10 if chr(c) in ".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c for c in range(256)
)


def parts(text: bytes, most: int) -> Iterator[bytes]:
    """A translated text in parts of about ``most`` bytes, cut at line ends."""
    start = 0
    while len(text) - start > most:
        cut = text.rfind(b"\n", start, start + most)
        if cut < 0 and (cut := text.find(b"\n", start + most)) < 0:
            break
        yield text[start:cut]
        start = cut + 1
    yield text[start:]


def coded(texts: list[str], most: int = PART) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Words in order, as numbers (-1 where a piece ends), and the word of each number."""
    for start, end in chunks(texts, most):
        whole = "\n".join(texts[start:end]).encode().translate(TABLE)
        for part in parts(whole, most):
            whole_part = pa.array([part.replace(b"\n", b" \n ")], pa.binary())
            tokens = pc.split_pattern(whole_part, pattern=b" ").flatten().dictionary_encode()
            codes, words = tokens.indices.to_numpy().astype(np.int64), np.array(tokens.dictionary.to_pylist(), object)
            skip, ends = (np.flatnonzero(words == x) for x in (b"", b"\n"))
            if len(skip):
                codes = codes[codes != skip[0]]
            if len(ends):
                codes = np.where(codes == ends[0], -1, codes)
            yield codes, words


def hashes(words: np.ndarray, lang: str) -> np.ndarray:
    """A number of 64 bits for each word (bytes) of a language."""
    own = pd.util.hash_array(np.array([lang], object), categorize=False)
    return pd.util.hash_array(words, categorize=False) ^ own


def joined(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The hashes of phrases, each with a word more."""
    with np.errstate(over="ignore"):
        return mix(first * np.uint64(31) + last)


def _has(filter_: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    at = phrase % np.uint64(8 * len(filter_))
    return (filter_[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def places(codes: np.ndarray, word: np.ndarray, filters: Sequence[np.ndarray], k: int) -> np.ndarray:
    """Where phrases of k words begin whose parts of fewer words all are in the filters (by length)."""
    inside = codes >= 0
    word = word[codes]
    fine, phrase = inside, word
    for n in range(1, k):
        if n <= len(filters):
            fine = fine.copy()
            at = np.flatnonzero(fine)
            fine[at] = _has(filters[n - 1], phrase[at])
        # A phrase of n + 1 words: both of its parts of n words are there.
        fine = fine[:-1] & fine[1:]
        if n < k - 1 and n < len(filters):
            phrase = joined(phrase[:-1], word[n:])
    return np.flatnonzero(fine)


def phrases(codes: np.ndarray, n_words: int, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The different phrases of k words that begin at the places, as rows of word numbers, and their counts."""
    rows, node = codes[at][:, None], codes[at]
    if k > 1:
        for n in range(1, k):
            node, keys = pd.factorize(node * n_words + codes[at + n])
            rows = np.column_stack([rows[keys // n_words] if n > 1 else keys // n_words, keys % n_words])
        return rows, np.bincount(node, minlength=len(rows))
    counts = np.bincount(node, minlength=n_words)
    return np.flatnonzero(counts)[:, None], counts[counts > 0]


class Node(dict):
    """Subtrees by word id; a plain dictionary is a container, of counts by the rest of the phrase."""


class HatTrie:
    """Counts of phrases of k words of one language; four bytes stand for a word."""

    def __init__(self, k: int, burst: int = Sizes.burst):
        self.k = k
        self.burst = burst
        self.clear()

    def clear(self) -> None:
        self.ids: dict[bytes, int] = {}
        self.words: list[bytes] = []
        self.root: dict = {}  # a container, until it bursts
        self.sizes: dict[int, int] = {}  # of the root's subtrees
        self.size = 0

    def add(self, rows: np.ndarray, counts: np.ndarray, words: np.ndarray) -> None:
        used, where = np.unique(rows, return_inverse=True)
        own = np.array(list(map(self._id, words[used])), ">u4")
        keys = np.ascontiguousarray(own[where.reshape(rows.shape)])
        width = 4 * self.k
        if type(self.root) is dict:
            raw = keys.tobytes()
            self.root, new = self._put(self.root, [raw[i : i + width] for i in range(0, len(raw), width)], counts.tolist())
            self.size += new
            if type(self.root) is Node:
                self.sizes = {first: sum(1 for _ in self._below(part, b"")) for first, part in self.root.items()}
            return
        order = np.argsort(keys[:, 0], kind="stable")
        raw = keys[order].tobytes()
        ends = np.flatnonzero(np.append(np.diff(keys[order, 0].astype(np.int64)) != 0, True)) + 1
        counts, start = counts[order].tolist(), 0
        for end in ends.tolist():
            first = int.from_bytes(raw[start * width : start * width + 4], "big")
            rests = [raw[i + 4 : i + width] for i in range(start * width, end * width, width)]
            self.root[first], new = self._put(self.root.get(first, {}), rests, counts[start:end])
            self.sizes[first] = self.sizes.get(first, 0) + new
            self.size += new
            start = end

    def _id(self, word: bytes) -> int:
        found = self.ids.get(word)
        if found is None:
            found = self.ids[word] = len(self.words)
            self.words.append(word)
        return found

    def _put(self, place: dict, rests: list[bytes], counts: list[int]) -> tuple[dict, int]:
        """Adds phrases to a subtree; the subtree, burst if it is too large, and how many are new."""
        if type(place) is dict:
            before = len(place)
            for rest, count in zip(rests, counts, strict=True):
                place[rest] = place.get(rest, 0) + count
            new = len(place) - before
            return (self._burst(place) if len(place) >= self.burst and len(rests[0]) > 4 else place), new
        below: dict[int, tuple[list[bytes], list[int]]] = {}
        for rest, count in zip(rests, counts, strict=True):
            part = below.setdefault(int.from_bytes(rest[:4], "big"), ([], []))
            part[0].append(rest[4:])
            part[1].append(count)
        total = 0
        for number, part in below.items():
            place[number], new = self._put(place.get(number, {}), *part)
            total += new
        return place, total

    @staticmethod
    def _burst(container: dict[bytes, int]) -> Node:
        node = Node()
        for rest, count in container.items():
            node.setdefault(int.from_bytes(rest[:4], "big"), {})[rest[4:]] = count
        return node

    def _below(self, place: dict, path: bytes) -> Iterator[tuple[bytes, int]]:
        if type(place) is dict:
            for rest, count in place.items():
                yield path + rest, count
        else:
            for number, part in place.items():
                yield from self._below(part, path + number.to_bytes(4, "big"))

    def spill(self, most: int, lang: str = UNKNOWN, hot: frozenset[bytes] = frozenset()) -> Iterator[pd.DataFrame]:
        """Runs of the largest subtrees until ``most`` entries are left; small ones share a run."""
        if self.size <= most:
            return
        table = WordTable(self.words, lang, hot)
        if type(self.root) is dict:
            yield self.run([(b"", self.root)], table)
            self.clear()
            return
        held: list[tuple[bytes, dict]] = []
        size = 0
        for first in sorted(self.sizes, key=self.sizes.get, reverse=True):
            if self.size <= most:
                break
            held.append((first.to_bytes(4, "big"), self.root.pop(first)))
            n = self.sizes.pop(first)
            size += n
            self.size -= n
            if size >= RUN:
                yield self.run(held, table)
                held, size = [], 0
        if held:
            yield self.run(held, table)
        if not self.size:
            self.clear()

    def run(self, parts: list[tuple[bytes, dict]], table: WordTable) -> pd.DataFrame:
        """A row for each first word and slot: its phrases in order, as the lines of one text, and their counts."""
        found = [entry for path, place in parts for entry in self._below(place, path)]
        ids = np.frombuffer(b"".join(key for key, _ in found), ">u4").reshape(len(found), self.k).astype(np.int64)
        counts = np.array([c for _, c in found], np.int64)
        if self.k == 1:
            first, slot = np.zeros(len(ids), np.int64), (table.hashes[ids[:, 0]] % np.uint64(WORD_SLOTS)).astype(np.int64)
            lead = np.array([b""], object)
        else:
            first, lead = ids[:, 0], table.words
            rest = reduce(joined, table.hashes[ids[:, 1:]].T)
            slot = np.where(table.hot[first], (rest % np.uint64(HOT_SLOTS)).astype(np.int64), 0)
            ids = ids[:, 1:]
        order = np.lexsort([*table.rank[ids].T[::-1], slot, first])
        first, slot, ids, counts = first[order], slot[order], ids[order], counts[order]
        phrase = table.words[ids[:, 0]]
        for n in range(1, ids.shape[1]):
            phrase = phrase + table.after[ids[:, n]]
        phrase = phrase.tolist()
        starts = np.flatnonzero(np.append(True, (np.diff(first) != 0) | (np.diff(slot) != 0)))
        spans = list(zip(starts.tolist(), [*starts[1:].tolist(), len(first)], strict=True))
        return pd.DataFrame(
            {
                "prefix": lead[first[starts]],
                "slot": slot[starts],
                "rests": [b"\n".join(phrase[a:b]) for a, b in spans],
                "counts": [counts[a:b] for a, b in spans],
                "k": self.k,
            }
        )


class WordTable:
    """A task's words in arrays: with their order, their hashes, and which are hot."""

    def __init__(self, words: list[bytes], lang: str, hot: frozenset[bytes]):
        self.words = np.array([*words, b""], object)[:-1]
        self.after = b" " + self.words
        self.rank = np.empty(len(words), np.int64)
        self.rank[self.words.argsort()] = np.arange(len(words))
        self.hashes = hashes(self.words, lang)
        self.hot = np.array([w in hot for w in words], bool)


RUNS = "prefix binary, slot int, rests binary, counts array<long>, k int, lang string"


@dataclass(frozen=True)
class Known:
    """What a pass knows of the ones before: filters by length, and the hot words of each language."""

    filters: tuple[np.ndarray, ...] = ()
    hot: dict[str, frozenset[bytes]] = field(default_factory=dict)


def counted(docs: DataFrame, lengths: tuple[int, ...], known: Known, sizes: Sizes) -> DataFrame:
    """lang, k, phrase and f of the phrases of so many words that the filters let pass."""
    sent = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tries: dict[tuple[str, int], HatTrie] = {}
        filters, hot = sent.value.filters, sent.value.hot

        def spilled(most: int) -> Iterator[pd.DataFrame]:
            left = sum(x.size for x in tries.values())
            for key in sorted(tries, key=lambda x: tries[x].size, reverse=True):
                size = tries[key].size
                for rows in tries[key].spill(max(0, most - (left - size)), key[0], hot.get(key[0], frozenset())):
                    yield rows.assign(lang=key[0])
                left -= size - tries[key].size

        for batch in batches:
            for lang, rows in batch.groupby("lang"):
                for codes, words in coded(strings(rows["text"])):
                    word = hashes(words, lang)
                    for k in lengths:
                        at = places(codes, word, filters, k)
                        if len(at):
                            trie = tries.setdefault((lang, k), HatTrie(k, sizes.burst))
                            trie.add(*phrases(codes, len(words), at, k), words)
                    if sum(x.size for x in tries.values()) > sizes.entries:
                        yield from spilled(sizes.entries // 2)
        yield from spilled(0)

    # The partition of a prefix merges its runs: their phrases are grouped without another shuffle.
    runs = docs.mapInPandas(run, RUNS).repartition("lang", "k", "prefix", "slot")
    rest = F.split(F.col("rests").cast("string"), "\n")
    single = runs.select("lang", "k", "prefix", "slot", F.inline(F.arrays_zip(rest.alias("rest"), F.col("counts").alias("f"))))
    merged = single.groupBy("lang", "k", "prefix", "slot", "rest").agg(F.sum("f").alias("f"))
    lead = F.col("prefix").cast("string")
    return merged.select("lang", "k", F.when(F.col("k") == 1, F.col("rest")).otherwise(F.concat(lead, F.lit(" "), "rest")).alias("phrase"), "f")


def filtered(frequent: DataFrame, size: int) -> np.ndarray:
    """The filter of frequent phrases of one length: that many bits, whatever their number."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, rows in batch.groupby("lang"):
                words = [x.encode().split(b" ") for x in rows["phrase"]]
                columns = [hashes(np.array(x, object), lang) for x in zip(*words, strict=True)]
                at = np.unique(reduce(joined, columns) % np.uint64(size)).astype(np.int64)
                yield pd.DataFrame({"byte": at >> 3, "bit": 1 << (at & 7)})

    rows = frequent.select("lang", "phrase").mapInPandas(run, "byte int, bit int")
    found = rows.groupBy("byte").agg(F.bit_or("bit").alias("bit")).toPandas()
    out = np.zeros(size // 8, np.uint8)
    out[found["byte"]] = found["bit"]
    return out


def frequencies(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, sizes: Sizes = Sizes()) -> tuple[DataFrame, DataFrame]:
    """lang, k, phrase, f of all phrases found ``least`` times or more; and lang, n: all its words."""
    texts = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    known, found, totals = Known(), None, None
    for lengths in ((1,), (2,), tuple(range(3, longest + 1))):
        counts = counted(texts, lengths, known, sizes)
        if totals is None:
            counts = staged(counts, "phrases-words")
            totals = staged(counts.groupBy("lang").agg(F.sum("f").alias("n")), "phrases-totals")
        frequent = staged(counts.where(F.col("f") >= least), "phrases")
        found = frequent if found is None else found.unionByName(frequent)
        if lengths[-1] < 3:
            hot = known.hot or hot_words(frequent, totals)
            known = Known((*known.filters, filtered(frequent, sizes.bits)), hot)
    return found, totals


def hot_words(words: DataFrame, totals: DataFrame) -> dict[str, frozenset[bytes]]:
    """The words that are a share of ``HOT`` or more of a language: at most 1 / HOT of them."""
    rows = words.join(totals, "lang").where(F.col("f") >= F.col("n") * HOT).select("lang", "phrase").collect()
    found: dict[str, set[bytes]] = {}
    for row in rows:
        found.setdefault(row.lang, set()).add(row.phrase.encode())
    return {lang: frozenset(x) for lang, x in found.items()}


def scored(found: DataFrame, totals: DataFrame) -> DataFrame:
    """lang, k, phrase, a, l, r, n, score of every candidate, by its lowest-scoring cut."""
    words = F.split("phrase", " ")
    cuts = (
        found.where("k > 1").select("lang", "k", "phrase", F.col("f").alias("a"), words.alias("words"))
        .withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
        .select(
            "lang", "k", "phrase", "a", "cut",
            F.array_join(F.slice("words", F.lit(1), F.col("cut")), " ").alias("left"),
            F.array_join(F.slice("words", F.col("cut") + 1, F.col("k")), " ").alias("right"),
        )
    )
    of = found.select("lang", "phrase", "f")
    both = cuts.join(of.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"]).join(
        of.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"]
    )
    wide = "cast({} as decimal(19, 0))".format
    score = F.expr(f"1000 * {wide('a')} * {wide('n')} div ({wide('l')} * {wide('r')})")
    lowest = F.min(F.struct("score", "cut", "l", "r"))
    return (
        both.join(totals, "lang").withColumn("score", score)
        .groupBy("lang", "k", "phrase", "a", "n").agg(lowest.alias("low"))
        .select("lang", "k", "phrase", "a", "low.l", "low.r", "n", "low.score")
    )


def outermost(candidates: DataFrame, found: DataFrame) -> DataFrame:
    """The candidates that no longer one as frequent holds."""
    words, n = F.split("phrase", " "), F.col("k") - 1
    inside = (
        found.where("k > 2")
        .select("lang", F.col("f").alias("a"), F.explode(F.array(F.slice(words, F.lit(1), n), F.slice(words, F.lit(2), n))).alias("words"))
        .select("lang", "a", F.array_join("words", " ").alias("phrase"))
        .distinct()
    )
    return candidates.join(inside, ["lang", "phrase", "a"], "left_anti")


def collocations(
    docs: DataFrame, *, longest: int = LONGEST, least: int = LEAST, best: int = BEST, sizes: Sizes = Sizes()
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's first ``best`` phrases."""
    found, totals = frequencies(docs, longest, least, sizes)
    kept = outermost(scored(found, totals), found)
    order = "order by score desc, a desc, phrase"
    # First the best of each share of a language, so that no task sorts all of its candidates.
    share = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    first = kept.withColumn("share", share).withColumn("place", F.expr(f"row_number() over (partition by lang, share {order})"))
    ranked = first.where(F.col("place") <= best).withColumn("rank", F.expr(f"row_number() over (partition by lang {order})"))
    return ranked.where(F.col("rank") <= best).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def registered(docs: DataFrame) -> DataFrame:
    return collocations(docs)
