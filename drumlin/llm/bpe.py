"""BPE encoding and decoding by prefix-sharing trie traversal.

The distinct words of a batch form a trie. A walk in depth-first order keeps, for each prefix on
the current path, the last token of the prefix's encoding; the encoding of a prefix is that of the
shorter prefix before its last token, plus that token. A token can end a prefix only if BPE leaves
it and the last token before it unmerged, which `Merges.seam` decides by undoing merges at the
seam. Prefixes that words share are worked out once. White space never meets a token, so texts are
cut there and each distinct piece is encoded once per worker.

Results for edge cases: null text is the empty text and has no ids; the vocabulary file's own
special strings inside a text become their ids; very long texts are encoded whole, in one row.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from itertools import chain
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from drumlin.llm.common import held, strings, tidy, trim

END = "</w>"
#: The pre-tokenizer's pattern and Unicode's white space, as the vocabulary file has them.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
SPACE = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
#: Python counts these as white space, Unicode doesn't.
ODD_SPACE = re.compile("[\x1c-\x1f]")
#: Pieces, and words, that a worker remembers at once.
MEMO = 120_000
#: Pairs of tokens it remembers.
SEAMS = 300_000


def byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte: itself, or one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def packed(token_id: int) -> bytes:
    return token_id.to_bytes(4, "little")


class State(NamedTuple):
    tail: str
    after: dict[str, State]
    inner: list[tuple[int, int, bytes]]
    final: list[tuple[int, int, bytes]]


class Merges:
    """Vocabulary and merge ranks, and which tokens may follow each other."""

    def __init__(self, vocabulary: str):
        spec = json.loads(vocabulary)
        self.ids: dict[str, int] = spec["model"]["vocab"]
        pairs = [tuple(x.split(" ")) if isinstance(x, str) else tuple(x) for x in spec["model"]["merges"]]
        self.rank = {pair: i for i, pair in enumerate(pairs)}
        self.parts = {a + b: (a, b) for a, b in pairs}
        self.born = {a + b: i for i, (a, b) in enumerate(pairs)}
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.heads = {x[:i] for x in self.ids for i in range(1, len(x) + 1)}
        self.states: dict[str, State] = {}
        self.letters = byte_letters()
        self._whole: dict[str, bool] = {}
        self.token = self.names()
        self.seams: dict[int, bool] = {}  # by the two ids: whether they may follow each other

    def names(self) -> dict[int, str]:
        return {i: x for x, i in self.ids.items()} | {i: x for x, i in self.special.items()}

    def seam(self, left: str, right: str, limit: float) -> bool:
        """Whether no merge across the seam comes before rank ``limit``, going back in time
        through the merges that built the two tokens. Of equal merges the left one comes first."""
        while True:
            rank = self.rank.get((left, right))
            if rank is not None and rank < limit:
                return False
            a, b = self.born.get(left, -1), self.born.get(right, -1)
            if a < 0 and b < 0:
                return True
            if a > b:
                limit, left = a, self.parts[left][1]
            else:
                limit, right = b + 1, self.parts[right][0]

    def adjacent(self, left: int, right: int) -> bool:
        found = self.seam(self.token[left], self.token[right], float("inf"))
        if len(self.seams) > SEAMS:
            self.seams.clear()
        self.seams[left << 32 | right] = found
        return found

    def whole(self, token: str) -> bool:
        """Whether BPE makes this very token of its own characters."""
        found = self._whole.get(token)
        if found is None:
            if token not in self.ids:
                found = False
            elif token not in self.parts:
                found = len(token.removesuffix(END) or token) == 1
            else:
                left, right = self.parts[token]
                found = self.whole(left) and self.whole(right) and self.seam(left, right, self.born[token])
            self._whole[token] = found
        return found

    def ends(self, tail: str, suffix: str) -> list[tuple[int, int, bytes]]:
        """Tokens (id, length, packed id) that a path with this tail can end in, longest first."""
        found = [tail[i:] + suffix for i in range(len(tail))]
        return [(self.ids[x], len(x) - len(suffix), packed(self.ids[x])) for x in found if self.whole(x)]

    def state(self, tail: str) -> State:
        """What follows from the longest end of a path that starts a token."""
        while tail and tail not in self.heads:
            tail = tail[1:]
        if tail not in self.states:
            self.states[tail] = State(tail, {}, self.ends(tail, ""), self.ends(tail, END))
        return self.states[tail]

    def encode(self, words: set[str]) -> dict[str, bytes]:
        """Packed ids of each word (in byte letters), sharing the work on common prefixes."""
        out: dict[str, bytes] = {}
        seams, adjacent = self.seams, self.adjacent
        room = max(map(len, words), default=0) + 1
        last, ids, states = [0] * room, [b""] * room, [self.state("")] * room  # of each prefix of the path, by length
        path = ""
        for word in sorted(words):  # depth-first order of the trie
            body = len(word) - 1
            same, most = 0, min(len(path), body)
            while same < most and path[same] == word[same]:
                same += 1
            state = states[same]
            for end in range(same, body + 1):
                letter = word[end]
                after = state[1].get(letter)
                if after is None:
                    after = state[1][letter] = self.state(state[0] + letter)
                state = after
                for token, length, raw in state[2] if end < body else state[3]:
                    start = end + 1 - length
                    if not start:
                        break
                    fits = seams.get(last[start] << 32 | token)
                    if fits or fits is None and adjacent(last[start], token):
                        break
                else:
                    raise ValueError(f"no token of the vocabulary ends {word[: end + 1]!r}")
                if end < body:
                    last[end + 1] = token
                    ids[end + 1] = ids[start] + raw
                    states[end + 1] = state
                else:
                    out[word] = ids[start] + raw
            path = word[:body]
        return out


class Encoder:
    """Ids of texts; remembers pieces between batches."""

    def __init__(self, vocabulary: str):
        self.merges = Merges(vocabulary)
        self.cut = re.compile("(" + "|".join(map(re.escape, self.merges.special)) + ")") if self.merges.special else None
        self.memo: dict[str, bytes] = {}  # by piece
        self.known: dict[str, bytes] = {}  # by word

    def letters(self, word: str) -> str:
        if word.isascii() and word.isprintable():
            return word
        return word.encode().decode("latin-1").translate(self.merges.letters)

    def pieces(self, text: str) -> list[str]:
        """Parts between white space, normalised; those with special strings as they are."""
        if self.cut and "<|" in text:
            found = []
            for piece in SPACE.split(text):
                found += [piece] if self.cut.search(piece) else [normal(piece)]
            return found
        text = normal(text)
        return SPACE.split(text) if ODD_SPACE.search(text) else text.split()

    def plan(self, piece: str) -> list[str | int]:
        """Words in byte letters and ids of special strings, in order."""
        out: list[str | int] = []
        for part in self.cut.split(piece) if self.cut and "<|" in piece else [piece]:
            if part in self.merges.special:
                out.append(self.merges.special[part])
            else:
                out += map(self.letters, PIECES.findall(normal(part)))
        return out

    def learn(self, pieces: set[str]) -> None:
        if len(self.memo) + len(pieces) > MEMO:
            self.memo = {x: self.memo[x] for x in pieces if x in self.memo}
        new = [x for x in pieces if x not in self.memo]
        plans: dict[str, list[str | int]] = {}
        for piece in new:
            if piece.isalpha():
                plans[piece] = [self.letters(piece)]
            elif piece[-1:] in (".", ",") and piece[:-1].isalpha():
                plans[piece] = [self.letters(piece[:-1]), piece[-1]]
            else:
                plans[piece] = self.plan(piece)
        words = {w for plan in plans.values() for w in plan if isinstance(w, str)}
        if len(self.known) + len(words) > MEMO:
            self.known = {x: self.known[x] for x in words if x in self.known}
        self.known |= self.merges.encode({x for x in words if x not in self.known})
        known, memo = self.known, self.memo
        for piece, plan in plans.items():
            if len(plan) == 1 and isinstance(plan[0], str):
                memo[piece] = known[plan[0]]
            else:
                memo[piece] = b"".join(known[w] if isinstance(w, str) else packed(w) for w in plan)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Offsets and ids of all texts."""
        cut = [self.pieces(x) for x in texts]
        self.learn(set(chain.from_iterable(cut)))
        values = [b"".join(map(self.memo.__getitem__, pieces)) for pieces in cut]
        offsets = np.cumsum([0, *(len(x) // 4 for x in values)])
        return offsets, np.frombuffer(b"".join(values), "<i4")


def normal(text: str) -> str:
    if not text.isascii():
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
    return text.lower()


def _slices(batch: pa.RecordBatch, rows: int) -> Iterator[pa.RecordBatch]:
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def encode(docs: DataFrame, vocabulary: str, *, text: str = "text", ids: str = "ids") -> DataFrame:
    """The rows with the ids of ``text`` as array<int> in place of the text (and of a column named ``ids``)."""
    content = docs.sparkSession.sparkContext.broadcast(Path(vocabulary).read_text())
    keep = [c for c in docs.columns if c not in (text, ids)]
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(ids, T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = held(f"bpe-{hash(content.value)}", lambda: Encoder(content.value))
        for whole in batches:
            for batch in _slices(whole, 1000):
                offsets, values = encoder.encode(strings(batch.column(len(keep)).to_pylist()))
                arrays = [batch.column(i) for i in range(len(keep))]
                arrays.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32())))
                yield pa.RecordBatch.from_arrays(arrays, names=[*keep, ids])

    return docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text)).mapInArrow(run, schema)


def list_offsets(lists: pa.ListArray) -> pa.Array:
    """Offsets into lists.flatten(); a null list is an empty one."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    return pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())


def decode(encoded: DataFrame, vocabulary: str, *, ids: str = "ids", text: str = "text") -> DataFrame:
    """The rows with the text of ``ids`` beside them: the tokens' names joined by one space, as
    the vocabulary file names no decoder. Null ids give the empty text."""
    content = encoded.sparkSession.sparkContext.broadcast(Path(vocabulary).read_text())
    keep = [c for c in encoded.columns if c != text]
    at = keep.index(ids)
    schema = T.StructType([encoded.schema[c] for c in keep] + [T.StructField(text, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spec = json.loads(content.value)
        known = {i: x for x, i in spec["model"]["vocab"].items()} | {x["id"]: x["content"] for x in spec["added_tokens"]}
        names = pa.array([known.get(i, "") for i in range(max(known) + 1)])
        del spec, known
        trim()
        for whole in batches:
            for batch in _slices(whole, 1000):
                lists = batch.column(at)
                tokens = pa.ListArray.from_arrays(list_offsets(lists), names.take(lists.flatten()))
                texts = pc.binary_join(tokens, " ")
                yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=[*keep, text])

    return encoded.select(*[F.col(f"`{c}`") for c in keep]).mapInArrow(tidy(run), schema)


def digests(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each document."""
    both = decode(encode(docs.select("doc_id", "text"), vocabulary), vocabulary)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("text"), 256).alias("decoded_sha256"),
    )
