"""Main text of web pages: page structure, and host suffix arrays for what structure leaves open.

A page is cut into blocks. What stands inside an article or main element is the page's text; menus,
headers, footers, sidebars, notices, adverts, forms, comments and the like are not. On a page that
names no article, blocks outside such parts are open. The token streams of a host's pages, all their
blocks in order, are concatenated and their suffixes sorted: substrings of ``RUN`` tokens that stand
on ``SHARE`` of the host's distinct pages, ``LEAST`` at least, are furniture. The text loses
stretches of them at its beginning and end, and open text those of ``LONG`` tokens too; an article
loses only what stands on ``INSIDE_SHARE`` of the pages, ``INSIDE_LEAST`` at least. A stretch takes
whole blocks, and of others only ``RUN`` tokens or more; blocks below that go with a stretch only.

Pages are distinct if their html is, and if they are no near copies: ``ALIKE`` of their substrings
are equal, by min-hashes. Near copies count as one page. Each page is parsed once and its blocks
are kept packed. A token of a repeated substring is itself on as many pages, and so is the bucket that its hash falls
into: pages are counted by bucket, a vector for each host and task, and of the streams only stretches of tokens of
such buckets move. A host's pages are dealt to shards of bounded size, each with a suffix array of its own. What stands on a share of a host's pages does so
in one of its shards at least; such substrings are then counted on all pages, so a host with a third
of all pages is many tasks and nothing is lost between them.

Results for edge cases: null or empty html gives the empty text; unclosed elements, comments and
tags end with the page; a null url is a host of its own; repeated rows give a result each; other
columns are kept, but for those named ``text`` or ``n_chars``.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from drumlin.llm.common import chunks, staged, tidy, unused
from drumlin.llm.neardup import components, mix

#: Tokens of the shortest substring that counts as repeated, and of a stretch that goes wherever it stands.
RUN, LONG = 8, 24
#: Furniture stands on this share of a host's distinct pages, and on so many at least.
SHARE, LEAST = 0.5, 3
#: The same for what goes from an article: lines that many texts begin with stand on up to two thirds of a small host's pages.
INSIDE_SHARE, INSIDE_LEAST = 0.9, 8
#: Near copies: share of equal min-hashes; bands of them that find the pairs.
ALIKE, BANDS, ROWS = 0.8, 8, 4
SHARD_PAGES = 500
#: A host's furniture is joined to its pages by as many keys.
SALTS = 64
#: Buckets that count the pages with a token: so many, at least, for each token of a mean page, and so many at most. Fewer let
#: more tokens pass for common, and lose none.
SPARE, MOST_BUCKETS = 8, 1 << 20
#: A host's buckets are added up in as many parts first.
PARTS = 16

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is no markup: skipped up to the end tag.
RAW = set("script style noscript template textarea title svg iframe object canvas select math".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp"
    " small span strike strong sub sup time tt u var wbr br".split()
)
NEVER = set("nav footer aside form head menu dialog button option audio video datalist".split())
ROLES = set("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar toolbar".split())
NAMES = re.compile(
    r"(?:^|[-_\s])(?:ads?|advert\w*|banners?|sponsor\w*|promo\w*|comments?|disqus|replies|respond|sidebars?|widgets?"
    r"|menus?|nav(?:bar|igation)?|breadcrumbs?|footer|masthead|cookies?|consent|notices?|popups?|modal|newsletter"
    r"|subscribe|share|sharing|social|related|recommended|toolbar|pagination|pager|skip)(?:$|[-_\s])",
    re.I,
)
COMMENT = re.compile(r"(?:^|[-_\s])(?:comments?|repl(?:y|ies))(?:$|[-_\s])", re.I)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")

MAIN, OPEN, OUT = "main", "open", "out"
#: Packed blocks: a letter for the kind, and the compressor's level.
CODES = {MAIN: "m", OPEN: "p", OUT: "x"}
KINDS = {letter: kind for kind, letter in CODES.items()}
PACK = 3
#: Multiplier of the hash of a substring.
PRIME = 0x100000001B3


class Block(NamedTuple):
    kind: str
    text: str


class Element(NamedTuple):
    name: str
    out: bool
    main: bool


def _attributes(raw: str) -> dict[str, str]:
    return {m[0].lower(): m[1] or m[2] or m[3] for m in ATTRIBUTE.findall(raw)} if "=" in raw else {}


def _left_out(name: str, raw: str, in_main: bool) -> bool:
    if name in NEVER or name == "header" and not in_main:
        return True
    if not raw:
        return False
    found = _attributes(raw)
    if found.get("role", "").lower() in ROLES or re.search(r"display\s*:\s*none", found.get("style", ""), re.I):
        return True
    names = f"{found.get('class', '')} {found.get('id', '')}"
    if name in ("html", "body", "main"):
        return False
    return bool((COMMENT if name == "article" else NAMES).search(names))


def _tag_end(page: str, at: int) -> int:
    """Place after the > that ends the tag, which may stand behind quoted ones; 0 if there is none."""
    end = page.find(">", at)
    while end >= 0 and (quote := _open_quote(page[at:end])):
        close = page.find(quote, end)
        if close < 0:  # a stray quote
            return page.find(">", at) + 1
        at, end = close + 1, page.find(">", close)
    return end + 1


def _open_quote(raw: str) -> str:
    """The quote of an attribute's value that has not ended yet."""
    at = raw.rfind("=")
    rest = raw[at + 1 :].lstrip() if at >= 0 else ""
    return rest[0] if rest[:1] in ("'", '"') and rest[0] not in rest[1:] else ""


def blocks(page: str) -> list[Block]:
    """Blocks of a page in order, with where they stand."""
    found: list[Block] = []
    stack = [Element("", False, False)]
    held: Counter = Counter()
    parts: list[str] = []

    def close() -> None:
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                top = stack[-1]
                found.append(Block(OUT if top.out else MAIN if top.main else OPEN, text))
            parts.clear()

    def pop() -> str:
        name = stack.pop().name
        held[name] -= 1
        return name

    at, n = 0, len(page)
    while at < n:
        tag = page.find("<", at)
        if tag < 0:
            parts.append(page[at:])
            break
        if tag > at:
            parts.append(page[at:tag])
        if page.startswith("<!--", tag):
            end = page.find("-->", tag + 4)
            at = n if end < 0 else end + 3
            continue
        m = TAG.match(page, tag)
        if not m:
            if page[tag + 1 : tag + 2] in ("!", "?", "/"):
                end = page.find(">", tag)
                at = n if end < 0 else end + 1
            else:
                parts.append("<")
                at = tag + 1
            continue
        end = _tag_end(page, m.end())
        at = end if end > 0 else n
        name = m[2].lower()
        if name not in INLINE:
            close()
        elif name == "br":
            parts.append(" ")
        if end <= 0:
            break
        if m[1]:
            if held[name]:
                if name in INLINE and stack[-1].out != _outer(stack, name):
                    close()
                while pop() != name:
                    pass
            continue
        if name in VOID:
            continue
        raw = page[m.end() : end - 1]
        if name in RAW:
            last = re.compile(f"</{re.escape(name)}\\b", re.I).search(page, at)
            stop = page.find(">", last.start()) if last else -1
            at = n if stop < 0 else stop + 1
            continue
        if name not in INLINE and held["p"] and _in_p(stack):
            while pop() != "p":
                pass
        top = stack[-1]
        out = top.out or _left_out(name, raw, top.main)
        main = top.main or name in ("article", "main") or "role=\"main\"" in raw or "articleBody" in raw
        if name in INLINE and out != top.out:
            close()
        if not raw.rstrip().endswith("/") or name in ("a",):
            stack.append(Element(name, out, main))
            held[name] += 1
    close()
    return found


def _outer(stack: list[Element], name: str) -> bool:
    """Whether what holds the innermost element of that name is left out."""
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].name == name:
            return stack[i - 1].out
    return stack[-1].out


def _in_p(stack: list[Element]) -> bool:
    for element in reversed(stack):
        if element.name == "p":
            return True
        if element.name not in INLINE:
            return False
    return False


def host(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


def content(html: Column) -> Column:
    """What makes pages distinct: 128 bits."""
    return F.unhex(F.md5(F.encode(html, "UTF-8")))


def suffix_runs(streams: list[list[str]], run: int = RUN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffix array of the concatenated streams down to ``run`` tokens: for each place that starts
    a substring of that length within its stream (or a whole shorter stream), the stream, the
    offset and the number of the substring, equal for equal ones."""
    sizes = np.array([len(x) for x in streams], np.int64)
    n = int(sizes.sum())
    if not n:
        return (np.zeros(0, np.int64),) * 3
    ranks = pd.factorize(np.array([t for x in streams for t in x], dtype=object))[0].astype(np.int64) + 1
    stream = np.repeat(np.arange(len(streams)), sizes)
    starts = np.repeat(np.cumsum(sizes) - sizes, sizes)
    offset = np.arange(n) - starts
    left = np.repeat(sizes, sizes) - offset  # tokens up to the stream's end
    length = 1
    while length < run:  # prefix doubling: order by the first 2 * length tokens
        step = min(length, run - length)
        after = np.zeros(n, np.int64)
        there = left > step
        after[there] = ranks[np.flatnonzero(there) + step]
        pairs = ranks * (int(ranks.max()) + 1) + after
        order = np.argsort(pairs, kind="stable")
        grown = np.empty(n, np.int64)
        grown[order] = np.cumsum(np.concatenate([[1], (np.diff(pairs[order]) != 0)]))
        ranks, length = grown, length + step
    starts_run = (left >= run) | (offset == 0)
    return stream[starts_run], offset[starts_run], ranks[starts_run]


def marks(tokens: list[str]) -> np.ndarray:
    """Hashes of the substrings of RUN tokens, by place."""
    n = len(tokens) - RUN + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    h = pd.util.hash_array(np.array(tokens, dtype=object), categorize=False)
    found = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(RUN):
            found *= np.uint64(PRIME)
            found += h[i : i + n]
    return mix(found).astype(np.int64)


def _sketch(found: np.ndarray) -> list[int]:
    """Min-hashes of a page's substrings by one permutation: the least hash of each of as many equal ranges; an empty
    range takes that of the next that is not. A page without any substring has none."""
    if not len(found):
        return []
    hashes = np.sort(found.astype(np.uint64))
    bins = BANDS * ROWS
    width = np.uint64((1 << 64) // bins)
    first = np.searchsorted(hashes, np.arange(bins, dtype=np.uint64) * width)
    own = first < np.searchsorted(hashes, np.arange(1, bins, dtype=np.uint64) * width, "left").tolist() + [len(hashes)]
    full = np.flatnonzero(own)
    after = full[np.searchsorted(full, np.arange(bins)) % len(full)]  # the range itself, or the next one that is full
    return (hashes[first[after]] & np.uint64(0x7FFFFFFF)).astype(np.int32).tolist()


def _tokens(parts: list[Block]) -> list[str]:
    return [t for b in parts for t in b.text.split(" ")]


def _packed(parts: list[Block]) -> bytes | None:
    """Blocks as bytes: they are kept and read again, and text packs well."""
    text = "\n".join(CODES[b.kind] + b.text for b in parts)
    return zstandard.compress(text.encode(), PACK) if parts else None


def _unpacked(body: bytes | None) -> list[Block]:
    return [Block(KINDS[x[0]], x[1:]) for x in zstandard.decompress(body).decode().split("\n")] if body else []


def _parsed(pages: DataFrame, keep: list[str], own: dict[str, str]) -> DataFrame:
    """The rows with uid, host, key, body (packed blocks) and sketch (null without a substring), named as in ``own``.
    Pages are parsed here only."""
    named = pages.select(
        *[F.col(f"`{c}`") for c in keep],
        F.monotonically_increasing_id().alias(own["uid"]),  # kept with the rows, so it stays
        host(F.col("url")).alias(own["host"]),
        content(F.col("html")).alias(own["key"]),
        F.col("html").alias(own["html"]),
    )
    out = [f"`{own['body']}` binary", f"`{own['sketch']}` array<int>"]
    given = named.drop(own["html"]).schema
    schema = T.StructType([*given.fields, *T.StructType.fromDDL(", ".join(out)).fields])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            bodies, sketches = [], []
            for page in batch.pop(own["html"]):
                parts = blocks(page) if isinstance(page, str) else []
                bodies.append(_packed(parts))
                sketches.append(_sketch(marks(_tokens(parts))) or None)
            yield batch.assign(**{own["body"]: bodies, own["sketch"]: sketches})

    return staged(named.mapInPandas(run, schema), "html-parsed")


def _firsts(streams: DataFrame) -> DataFrame:
    """page, host of the distinct pages: of equal ones and of near copies within a host the least stays. No text is moved."""
    distinct = streams.groupBy("host", "key").agg(F.min("uid").alias("page"), F.first("sketch").alias("sketch"))
    distinct = staged(distinct.select("page", "host", "sketch"), "html-distinct")
    bands = distinct.select(
        "page",
        F.explode(F.array(*[F.xxhash64("host", F.lit(i), F.slice("sketch", i * ROWS + 1, ROWS)) for i in range(BANDS)])).alias("band"),
    )
    least = bands.groupBy("band").agg(F.min("page").alias("least"), F.max("page").alias("most")).where("least < most")
    pairs = bands.join(least, "band").where("page <> least").select("page", "least").distinct()
    both = pairs.join(distinct.select("page", "sketch"), "page")
    both = both.join(distinct.select(F.col("page").alias("least"), F.col("sketch").alias("other")), "least")
    equal = F.size(F.filter(F.zip_with("sketch", "other", lambda x, y: x == y), lambda x: x))
    links = staged(both.where(equal >= math.ceil(ALIKE * BANDS * ROWS)).select(F.col("page").alias("a"), F.col("least").alias("b")), "html-links")
    firsts = distinct.select("page", "host")
    if links.isEmpty():
        return firsts
    copies = components(links).where("node <> component").select(F.col("node").alias("page"))
    return staged(firsts.join(copies, "page", "left_anti"), "html-firsts")


def _hashed(bodies: Sequence[bytes]) -> tuple[list[list[str]], np.ndarray, np.ndarray]:
    """Token streams of packed pages, the hash of each token and its page's place."""
    streams = [_tokens(_unpacked(x)) for x in bodies]
    codes, words = pd.factorize(np.array([t for x in streams for t in x], dtype=object))
    hashes = pd.util.hash_array(words, categorize=False).astype(np.int64)
    return streams, hashes[codes], np.repeat(np.arange(len(streams)), [len(x) for x in streams])


def _packed_counts(counts: np.ndarray) -> bytes:
    """Counts as bytes, each as wide as the largest needs; the first byte says how wide."""
    narrow = counts.astype(np.min_scalar_type(int(counts.max())))
    return bytes([narrow.itemsize]) + zstandard.compress(narrow.tobytes(), PACK)


def _unpacked_counts(body: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(body[1:]), f"<u{body[0]}")


def _token_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """host, size, counts: for each bucket of token hashes, pages of a part of a batch that hold one of its tokens."""
    for batch in batches:
        for start, end in chunks(list(batch["body"])):
            _, tokens, page = _hashed(batch["body"].iloc[start:end])
            held = pd.DataFrame({"page": page, "token": tokens}).drop_duplicates()
            held["host"] = batch["host"].iloc[start:end].to_numpy()[held["page"]]
            rows = []
            for name, own in held.groupby("host", sort=False):
                mean = len(own) / own["page"].nunique()
                size = min(MOST_BUCKETS, 1 << math.ceil(math.log2(SPARE * mean)))
                bucket = np.unique(own["page"].to_numpy() * size + (own["token"].to_numpy() & (size - 1))) % size
                rows.append((name, size, _packed_counts(np.bincount(bucket, minlength=size))))
            yield pd.DataFrame(rows, columns=["host", "size", "counts"])


def _added(bodies: Sequence[bytes], size: int) -> np.ndarray:
    """Sum of counts, each at most ``size`` long; of a shorter one a bucket counts for all it was cut into."""
    total = np.zeros(size, np.int64)
    for body in bodies:
        counts = _unpacked_counts(body)
        total.reshape(-1, len(counts))[:] += counts
    return total


def _part(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"host": key[:1], "size": key[1:2], "counts": [_packed_counts(_added(rows["counts"], key[1]))]})


def _common(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """A bit for each of the host's buckets: whether a token of it may stand on the share of the distinct pages."""
    bits = _added(rows["counts"], rows["size"].max()) >= max(LEAST, SHARE * rows["pages"].iloc[0])
    return pd.DataFrame({"_host": key, "common": [np.packbits(bits).tobytes()]})


def _stretches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """host, uid, text: the stretches of RUN tokens or more that are all in common buckets, a line each."""
    for batch in batches:
        for start, end in chunks(list(batch["body"])):
            part, rows = batch.iloc[start:end], []
            streams, tokens, page = _hashed(part["body"])
            ends = np.searchsorted(page, np.arange(len(streams) + 1))
            for i, (name, uid, common) in enumerate(zip(part["host"], part["uid"], part["common"], strict=True)):
                bits = np.unpackbits(np.frombuffer(common, np.uint8))
                is_common = bits[tokens[ends[i] : ends[i + 1]] & (len(bits) - 1)]
                edges = np.flatnonzero(np.diff(np.concatenate([[0], is_common.astype(np.int8), [0]])))
                lines = [" ".join(streams[i][a:b]) for a, b in zip(edges[::2], edges[1::2], strict=True) if b - a >= RUN]
                if lines:
                    rows.append((name, uid, "\n".join(lines)))
            yield pd.DataFrame(rows, columns=["host", "uid", "text"])


def _shard(key: tuple, texts: pd.DataFrame, firsts: pd.DataFrame) -> pd.DataFrame:
    """Substrings that stand on the share of a shard's distinct pages."""
    rows = texts[texts["uid"].isin(firsts["page"])].sort_values("uid", kind="stable")
    lines = [(i, line.split(" ")) for i, text in enumerate(rows["text"]) for line in text.split("\n")]
    pages, streams = np.array([i for i, _ in lines], np.int64), [x for _, x in lines]
    stream, offset, number = suffix_runs(streams)
    places = pd.DataFrame({"page": pages[stream], "stream": stream, "at": offset, "number": number})
    places = places.drop_duplicates(["page", "number"])
    counts = places.groupby("number").agg(n=("page", "size"), stream=("stream", "first"), at=("at", "first"))
    wide = counts[counts["n"] >= SHARE * len(firsts)]
    found = [marks(streams[i][at : at + RUN])[0] for i, at in zip(wide["stream"], wide["at"], strict=True)]
    return pd.DataFrame({"host": key[0], "mark": np.array(found, np.int64)})


def _salted(known: DataFrame) -> DataFrame:
    """Each host's marks, and those for articles, once for each salt."""
    lists = known.groupBy("host").agg(
        F.collect_set("mark").alias("marks"), F.collect_set(F.when(F.col("inside"), F.col("mark"))).alias("inside")
    )
    return lists.select(F.col("host").alias("_host"), "marks", "inside", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))


def furniture(parsed: DataFrame) -> DataFrame:
    """host, mark: the substrings that stand on the share of the host's distinct pages; inside: whether articles lose them."""
    streams = parsed.where(F.col("sketch").isNotNull())
    firsts = _firsts(streams)
    rows = streams.groupBy("host").agg(F.count("*").alias("rows"))
    sizes = firsts.groupBy("host").agg(F.count("*").alias("pages")).where(F.col("pages") >= LEAST).join(rows, "host")
    # A shard holds so many rows, copies included, whatever share of them is distinct.
    sizes = staged(sizes.select(F.col("host").alias("_host"), "pages", F.ceil(F.col("rows") / SHARD_PAGES).cast("int").alias("shards")), "html-hosts")
    of_host = F.col("host") == F.col("_host")

    # Each token of such a substring stands on the share of the distinct pages too, and on no fewer with the copies; the
    # bucket of its hash is on as many pages at least. So only stretches of tokens of such buckets are moved.
    counts = "host string, size long, counts binary"
    found = streams.select("host", "body").mapInPandas(tidy(_token_counts), counts).withColumn("part", F.pmod(F.spark_partition_id(), F.lit(PARTS)))
    found = found.groupBy("host", "size", "part").applyInPandas(_part, counts).join(sizes, of_host)
    common = found.select("host", "size", "counts", "pages").groupBy("host").applyInPandas(_common, "_host string, common binary")
    common = common.select("_host", "common", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    by = F.pmod("uid", F.lit(SALTS)).cast("int")
    asked = streams.select("host", "uid", "body").join(staged(common, "html-common"), of_host & (by == F.col("_salt")))
    moved = asked.select("host", "uid", "body", "common").mapInPandas(_stretches, "host string, uid long, text string")

    def dealt(frame: DataFrame, uid: str) -> DataFrame:
        named = frame.join(sizes, of_host).withColumn("shard", F.pmod(F.hash(uid), "shards"))
        # By both: a join by host before would leave all shards of one in a task.
        return named.drop("_host", "pages", "shards").repartition("host", "shard").groupBy("host", "shard")

    found = dealt(moved, "uid").cogroup(dealt(firsts, "page")).applyInPandas(_shard, "host string, mark long")
    likely = staged(found.distinct(), "html-likely")

    def standing(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [
                (h, uid, m) for h, uid, body, own in zip(batch["host"], batch["uid"], batch["body"], batch["marks"], strict=True)
                for m in np.intersect1d(marks(_tokens(_unpacked(body))), own)
            ]
            yield pd.DataFrame(found, columns=["host", "page", "mark"])

    salted = _salted(likely.withColumn("inside", F.lit(False)))
    asked = streams.join(salted, of_host & (by == F.col("_salt")))
    seen = asked.select("host", "uid", "body", "marks").mapInPandas(standing, "host string, page long, mark long")
    counts = seen.join(firsts.select("page"), "page", "left_semi").groupBy("host", "mark").agg(F.count("*").alias("n"))
    wide = counts.join(sizes, of_host).where((F.col("n") >= LEAST) & (F.col("n") >= SHARE * F.col("pages")))
    inside = (F.col("n") >= INSIDE_LEAST) & (F.col("n") >= INSIDE_SHARE * F.col("pages"))
    return staged(wide.select("host", "mark", inside.alias("inside")), "html-furniture")


def _gone(covered: np.ndarray, everywhere: bool) -> np.ndarray:
    """Of covered tokens those in stretches at the beginning or end, or long ones."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], covered.astype(np.int8), [0]])))
    gone = np.zeros(len(covered), bool)
    for start, end in zip(edges[::2], edges[1::2], strict=True):
        if start == 0 or end == len(covered) or everywhere and end - start >= LONG:
            gone[start:end] = True
    return gone


def main_text(parts: list[Block], known: Sequence[int], inside: Sequence[int] = ()) -> str:
    """The page's text; known are the marks of its host's furniture, inside those that articles lose."""
    whole = any(b.kind == MAIN for b in parts)
    known = inside if whole else known
    kind = MAIN if whole else OPEN
    if not len(known):
        return "\n".join(b.text for b in parts if b.kind == kind)
    tokens = _tokens(parts)
    covered = np.zeros(len(tokens) + RUN, bool)
    for at in np.flatnonzero(np.isin(marks(tokens), np.asarray(known, np.int64))):
        covered[at : at + RUN] = True
    at, kept = 0, []
    for b in parts:
        own = b.text.split(" ")
        if b.kind == kind:
            here = covered[at : at + len(own)].copy()
            if not here.all():  # stretches of other blocks that reach into this one
                edges = np.flatnonzero(np.diff(np.concatenate([[0], here.astype(np.int8), [0]])))
                for start, end in zip(edges[::2], edges[1::2], strict=True):
                    if end - start < RUN:
                        here[start:end] = False
            kept.append((own, here))
        at += len(own)
    if not kept:
        return ""
    gone = _gone(np.concatenate([here for _, here in kept]), not whole)
    lines, at = [], 0
    for own, _ in kept:
        lines.append(" ".join(t for t, out in zip(own, gone[at : at + len(own)], strict=True) if not out))
        at += len(own)
    return "\n".join(x for x in lines if x)


def extract(pages: DataFrame) -> DataFrame:
    """The rows without ``html``, with ``text``: the page's main text. Needs url and html."""
    keep = [c for c in pages.columns if c not in ("html", "text", "n_chars")]
    own = {c: unused(c, keep) for c in ("uid", "host", "key", "html", "body", "sketch", "marks", "inside")}
    parsed = _parsed(pages, keep, own)
    inner = ("uid", "host", "key", "body", "sketch")
    known = _salted(furniture(parsed.select(*[F.col(own[c]).alias(c) for c in inner]))).withColumnsRenamed(
        {"marks": own["marks"], "inside": own["inside"], "_host": unused("_host", keep), "_salt": unused("_salt", keep)}
    )
    salt = F.pmod(F.col(own["uid"]), F.lit(SALTS)).cast("int")
    rows = parsed.join(
        known, (F.col(own["host"]) == F.col(unused("_host", keep))) & (salt == F.col(unused("_salt", keep))), "left"
    )
    schema = T.StructType([pages.schema[c] for c in keep] + [T.StructField("text", T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [
                main_text(_unpacked(body), *((known, inside) if known is not None else ((), ())))
                for body, known, inside in zip(batch[own["body"]], batch[own["marks"]], batch[own["inside"]], strict=True)
            ]
            yield batch[keep].assign(text=texts)

    flat = rows.select(*[F.col(f"`{c}`") for c in keep], *[F.col(own[c]) for c in ("body", "marks", "inside")])
    return flat.mapInPandas(run, schema)


def registered(pages: DataFrame) -> DataFrame:
    found = extract(pages.select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
