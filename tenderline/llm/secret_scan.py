"""Secrets in texts: plain patterns, and weak candidates that count only beside their complement."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderline.llm.shared import stored
from tenderline.llm.text import texts_of

#: The kinds of spans in the order in which equal starts are listed. The first three are always reported.
KINDS = ("assign", "access", "hex", "key_id", "bare_secret", "endpoint")
BASE_KINDS = 3
#: What each kind is a part of: an identifier of a key, a secret, or the place where both are used.
IDENTIFIER, SECRET, ENDPOINT = "identifier", "secret", "endpoint"
ROLES = (SECRET, IDENTIFIER, SECRET, IDENTIFIER, SECRET, ENDPOINT)

#: The patterns. All but the upper-case ones meet letters in either case.
ASSIGN = rb"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)"""
ACCESS = rb"AKIA[A-Z0-9]+"
HEX = rb"[0-9a-f]{32,}"
KEY_ID = rb"""(?:(?:access_?key|client|account|tenant|user|app)_?(?:id|name)|username|login|user)["']?\x20*[:=]\x20*["']?[a-z0-9._@-]{4,}"""
TEMPORARY_ID = rb"(?<![A-Za-z0-9])(?:ASIA|AROA|AIDA)[A-Z0-9]{12,}"
BARE = rb"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}"
URL = rb"""[a-z][a-z0-9+.-]{1,15}://[^\x00-\x20"'<>]+"""
HOST = rb"""(?:host(?:name)?|endpoint|server|bucket|region)["']?\x20*[:=]\x20*["']?[a-z0-9.:/_-]{4,}"""
SCOPE_END = rb"\n[\x20\t\r]*\n"

#: Characters between two parts that may still belong together.
REACH = 400
MIN_ENTROPY = 3.5

PART = "struct<start:bigint,kind:int,stop:bigint,scope:bigint>"


def _mixed_enough(token: bytes) -> bool:
    """Lower and upper case and digits, and as many different signs as random text has."""
    n = len(token)
    kinds = any(97 <= c <= 122 for c in token) and any(65 <= c <= 90 for c in token) and any(48 <= c <= 57 for c in token)
    return kinds and -sum(k / n * math.log2(k / n) for k in Counter(token).values()) >= MIN_ENTROPY


class Patterns:
    def __init__(self):
        self.assign, self.access, self.hex = map(re.compile, (ASSIGN, ACCESS, HEX))
        self.ids = [(re.compile(KEY_ID), True), (re.compile(TEMPORARY_ID), False)]
        self.places = [(re.compile(URL), True), (re.compile(HOST), True)]
        self.bare, self.scope_end = re.compile(BARE), re.compile(SCOPE_END)

    def base(self, data: bytes, lower: bytes) -> list[tuple[int, int, int]]:
        """(start, kind, stop) in bytes of the spans that are reported whatever is near them."""
        out = [(m.start(), 0, m.end()) for m in self.assign.finditer(lower) if m.end(1) - m.start(1) >= 8]
        if b"AKIA" in data:
            out += [(m.start(), 1, m.end()) for m in self.access.finditer(data) if m.end() - m.start() >= 16]
        return out + [(m.start(), 2, m.end()) for m in self.hex.finditer(data)]

    def weak(self, data: bytes, lower: bytes, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """Parts that say nothing alone; none where no identifier is in the text, since then nothing can be linked."""
        taken = sorted((s, e) for s, _, e in base)
        ids = _apart([(m.start(), 3, m.end()) for p, low in self.ids for m in p.finditer(lower if low else data)], taken)
        if not ids and not any(k == 1 for _, k, _ in base):
            return []
        taken = sorted(taken + [(s, e) for s, _, e in ids])
        bare = _apart([(m.start(), 4, m.end()) for m in self.bare.finditer(data) if _mixed_enough(m[0])], taken)
        places = _apart([(m.start(), 5, m.end()) for p, low in self.places for m in p.finditer(lower if low else data)], taken)
        return ids + bare + places

    def parts(self, text: str) -> list[tuple[int, int, int, int]]:
        """(start, kind, stop, scope) in characters; the scope is the number of blank lines before the part."""
        data = text.encode("utf-8", "surrogatepass")
        lower = data.lower()
        found = self.base(data, lower)
        found = sorted(found + self.weak(data, lower, found))
        if not found:
            return []
        breaks = [m.start() for m in self.scope_end.finditer(data)] if len(found) > 1 else []
        place = _characters(data, sorted({p for s, _, e in found for p in (s, e)}))
        out, scope = [], 0
        for start, kind, stop in found:
            while scope < len(breaks) and breaks[scope] < start:
                scope += 1
            out.append((place[start], kind, place[stop], scope))
        return out


def _apart(spans: list[tuple[int, int, int]], taken: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """Spans in order, without those that overlap one before or one of `taken` (sorted)."""
    out, last, at, reached = [], -1, 0, -1
    for start, kind, stop in sorted(spans):
        while at < len(taken) and taken[at][0] < stop:
            reached = max(reached, taken[at][1])
            at += 1
        if start >= max(last, reached):
            out.append((start, kind, stop))
            last = stop
    return out


def _characters(data: bytes, places: list[int]) -> dict[int, int]:
    """Numbers of characters before places in UTF-8 bytes."""
    if data.isascii():
        return {p: p for p in places}
    out, last, count = {}, 0, 0
    for p in places:
        count += len(data[last:p].decode("utf-8", "surrogatepass"))
        out[p], last = count, p
    return out


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    patterns = Patterns()
    kind = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("stop", pa.int64()), ("scope", pa.int64())]))
    for batch in batches:
        rows = [[dict(zip(("start", "kind", "stop", "scope"), p, strict=True)) for p in patterns.parts(t)] if t else [] for part in texts_of(batch.column(1), 256) for t in part]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind)], names=["doc_id", "parts"])


def _of(column: str, values: list[int]) -> Column:
    return F.col(column).isin(values)


def _with_role(role: str) -> list[int]:
    return [k for k, r in enumerate(ROLES) if r == role]


def linked(parts: DataFrame, reach: int = REACH) -> DataFrame:
    """Interval join of the parts of a text: rows (tag, scope, start, kind, stop) with what is within reach of each.

    Returns each part that has an identifier, a secret or an endpoint in reach besides itself, with `near_identifier`,
    `near_secret` and `near_endpoint`: the closest one as a struct (gap, start, stop), null if there is none; of equally close ones that
    which starts first. Two parts are in reach when they are in one scope and at most `reach` characters lie between
    them. Texts are cut into cells of `reach` characters; a part is in every cell it touches, its reach in the cells around, and
    the join is on text, scope and cell, so a long text is spread over many keys. Parts of one role are found by one pattern
    or patterns that do not overlap, so a cell holds no more pairs than its length allows."""
    cells = "explode(sequence(cast(floor({} / {r}) as bigint), cast(floor({} / {r}) as bigint))) as cell"
    left = parts.selectExpr("tag", "scope", "start", "kind", "stop", cells.format(f"greatest(0, start - {reach})", f"(stop - 1 + {reach})", r=reach))
    right = parts.selectExpr("tag", "scope", "start as s", "kind as k", "stop as e", cells.format("start", "(stop - 1)", r=reach))
    near = left.join(right, ["tag", "scope", "cell"]).where(f"(s, k, e) <> (start, kind, stop) and s <= stop + {reach} and start <= e + {reach}")
    place = F.struct(F.greatest(F.lit(0), F.col("s") - F.col("stop"), F.col("start") - F.col("e")).alias("gap"), F.col("s").alias("start"), F.col("e").alias("stop"))
    closest = [F.min(F.when(_of("k", _with_role(role)), place)).alias(f"near_{role}") for role in (IDENTIFIER, SECRET, ENDPOINT)]
    return near.groupBy("tag", "scope", "start", "kind", "stop").agg(*closest)


def secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = REACH) -> DataFrame:
    """Per row: doc_id, parts (the reported spans, structs of start, kind, stop and scope, in order), credentials.

    Starts and stops are in characters (code points), stops exclusive; `kind` is a place in KINDS. Always reported: assignments of passwords and
    the like to values of 8 and more characters, access identifiers of 16 and more, hexadecimal runs of 32 and more; per kind leftmost and not
    overlapping. Weak candidates (names and identifiers of accounts, mixed tokens without a name, addresses and hosts) do not
    overlap those, and are reported only beside their complement within reach in the same scope (no blank line
    between): an identifier beside a secret, a secret beside an identifier, an endpoint beside both.
    `credentials` has, for each reported identifier with a secret in reach, start and stop of it, of the closest
    secret and of the closest endpoint (null if there is none), in order.

    Whole texts. Null and empty texts have no parts. Rows are independent: null and repeated ids are rows like others.
    Other columns are not read. Only parts are shuffled, and only those of texts that have both an identifier and a secret."""
    rows = docs.selectExpr(f"cast(`{id_col}` as bigint) as doc_id", f"`{text_col}` as text")
    found = rows.mapInArrow(_found, f"doc_id long, parts array<{PART}>")
    found = stored(found.withColumn("tag", F.monotonically_increasing_id()), "parts")
    has = lambda role: F.exists("parts", lambda p: p.kind.isin(_with_role(role)))
    both = has(IDENTIFIER) & has(SECRET)
    pair = "start:bigint,stop:bigint"
    none = F.lit(None).cast(f"array<struct<identifier:struct<{pair}>,secret:struct<{pair}>,endpoint:struct<{pair}>>>")

    near = linked(found.where(both).select("tag", F.inline("parts")), reach)
    wanted = F.when(_of("kind", _with_role(IDENTIFIER)), F.col("near_secret").isNotNull()).when(_of("kind", _with_role(SECRET)), F.col("near_identifier").isNotNull())
    wanted = wanted.otherwise(F.col("near_identifier").isNotNull() & F.col("near_secret").isNotNull())
    near = near.where(wanted)
    weak = F.when(F.col("kind") >= BASE_KINDS, F.struct("start", "kind", "stop", "scope"))
    span = lambda c: F.when(F.col(c).isNotNull(), F.struct(F.col(f"{c}.start").alias("start"), F.col(f"{c}.stop").alias("stop")))
    credential = F.struct(F.struct("start", "stop").alias("identifier"), span("near_secret").alias("secret"), span("near_endpoint").alias("endpoint"))
    per_text = near.groupBy("tag").agg(
        F.collect_list(weak).alias("weak"),
        F.sort_array(F.collect_list(F.when(_of("kind", _with_role(IDENTIFIER)), credential))).alias("credentials"),
    )
    base = F.filter("parts", lambda p: p.kind < BASE_KINDS)
    alone = found.where(~both).select("doc_id", base.alias("parts"), none.alias("credentials"))
    beside = found.where(both).join(per_text, "tag", "left")
    beside = beside.select("doc_id", F.sort_array(F.concat(base, F.coalesce("weak", F.array().cast(f"array<{PART}>")))).alias("parts"), "credentials")
    return alone.unionByName(beside)


def listed(parts: str) -> Column:
    """kind:start:end of spans, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(parts, lambda p: F.concat_ws(":", F.get(names, p.kind), p.start, p.stop)), ",")


def scan_report(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_credentials, of `secrets`."""
    found = secrets(docs)
    count = lambda kind: F.size(F.filter("parts", lambda p: p.kind == kind)).cast("long")
    found = found.withColumn("base", F.filter("parts", lambda p: p.kind < BASE_KINDS))
    counts = [count(k).alias(f"n_{KINDS[k]}") for k in range(BASE_KINDS)]
    return found.select(
        "doc_id", *counts, F.sha2(listed("base"), 256).alias("base_sha256"), listed("parts").alias("spans"), F.coalesce(F.size("credentials"), F.lit(0)).cast("long").alias("n_credentials")
    )
