"""Operator 5: benchmark decontamination over canonical templates.

Numbers, names (capitalised words inside a sentence) and units after a number become typed
placeholders, other words lose case and outer marks. Capitals say nothing of names where a passage was
set in capitals or in small letters, so a window that holds names has a second, folded template in
which they are plain words. Windows of WORDS template tokens of documents and benchmark items meet in a
hash join, named templates and folded ones apart. On each diagonal (a run of windows at one distance) the
placeholders' values must match one to one: an item's value always stands for the same value of the
document and the other way round. An item is leaked when consistent diagonals cover `share` of its
windows, so re-parameterised questions are caught and chance mixtures are not, or when a diagonal holds
LONG consecutive words of it with their very values (case apart), whatever its share.

Windows of placeholders alone say nothing (a table of numbers would meet every item that has one): they
are no windows, neither of items nor of documents. A window of which only names are left in its named
template has the folded one alone.

Defined cases: null and empty texts have no windows; an item of fewer than WORDS tokens, or without a
plain word, cannot leak (so short a part is in clean texts too); columns that share a name are not used;
repeated rows with one doc_id count as one document; rows with a null id are not searched; empty
tables give an empty result; other columns are not used.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches, texts
from .words import draws, grouped, hashes_of, mixed, odd_white

WORDS, SHARE, LONG = 5, 0.8, 13
#: Up to so many benchmark windows are sent to the executors to sift documents before the join (8 bytes each).
SIFT = 2_000_000
# Units that become a placeholder after a number.
UNITS = frozenset(
    "mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres kilometer "
    "kilometers kilometre kilometres mg g kg t lb lbs oz gram grams kilogram kilograms ton tons tonne tonnes pound "
    "pounds ounce ounces ml cl l liter liters litre litres gallon gallons s sec min h hr hrs second seconds minute "
    "minutes hour hours day days week weeks month months year years percent % usd eur gbp dollar dollars euro euros "
    "cent cents mph kph kmh w kw kwh v volt volts watt watts degree degrees".split()
)
_NUMBER = re.compile(r"[+\-$€£]?\d[\d.,:/]*(?:%|[a-z]{1,3})?")
_EDGE = "\"'()[]{}<>.,;:!?*#&|_~`"
_SKIP, _END, _CAPITAL, _NUM, _UNIT = 1, 2, 4, 8, 16
_PLACE = draws(64, 23)
_NAME_CODE, _NUM_CODE, _UNIT_CODE = (np.uint64(x) for x in (3, 5, 7))
#: Templates of a window: one without names has PLAIN alone, any other NAMED and FOLDED.
PLAIN, NAMED, FOLDED = 0, 1, 2


def _bytes(chars: str) -> np.ndarray:
    found = np.zeros(256, bool)
    found[list(chars.encode())] = True
    return found


_IS_WHITE, _IS_EDGE, _IS_CLOSE = _bytes(" \t\n\r\v\f\x1c\x1d\x1e\x1f"), _bytes(_EDGE), _bytes("\"')]}*#&|_~`")
_IS_STOP, _IS_UPPER, _STARTS_NUMBER = _bytes(".!?"), _bytes("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _bytes("+-$0123456789")


def _codes(cores: list[str]) -> np.ndarray:
    folded = [c.casefold().encode() for c in cores]
    sizes = np.array(list(map(len, folded)), np.int64)
    return hashes_of(np.frombuffer(b"".join(folded), np.uint8), np.cumsum(sizes) - sizes, sizes)


_UNIT_CODES = np.sort(_codes(sorted(UNITS)))


def tokens(docs: list[str]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All tokens of the texts: the texts' bytes, then each token's text number, first byte and size without outer
    marks, hash of it in lower case, and flags. A token after a line end has _END set on the one before it."""
    parts = [t.encode() for t in docs]
    raw = b"\n".join(parts) + b"\n"
    until = np.cumsum([len(p) + 1 for p in parts])
    data = np.frombuffer(raw, np.uint8).copy()
    data[odd_white(data)] = 32
    white = _IS_WHITE[data]
    edge = np.flatnonzero(np.diff(~white, prepend=False, append=False))
    low, high = edge[::2], edge[1::2]
    doc = np.searchsorted(until, low, "right")

    def bounds(inner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last byte of each token that is in `inner`; none where last < first."""
        inner = inner & ~white
        seen = np.concatenate([[0], np.cumsum(inner, dtype=np.int32)])
        at = np.append(np.flatnonzero(inner), len(data))
        first, last = seen[low], seen[high] - 1
        return at[first], np.where(last < first, -1, at[np.maximum(last, 0)])

    first, last = bounds(~_IS_EDGE[data])
    size = np.where(last < 0, 0, last - first + 1)
    flags = np.where(size == 0, _SKIP, 0)
    _, close = bounds(~_IS_CLOSE[data])
    flags[(close >= 0) & _IS_STOP[data[close]]] |= _END
    lines = np.cumsum(data == 10, dtype=np.int32)
    flags[:-1][lines[low[1:] - 1] > lines[high[:-1] - 1]] |= _END
    # letters of two bytes from C3 on have their upper case 32 below; others but ASCII take the slow way
    c3 = np.flatnonzero(data == 0xC3) + 1
    upper = c3[(data[c3] < 0x9F) & (data[c3] != 0x97)]
    hard = data >= 0x80
    easy = c3[(data[c3] != 0x9F)]
    hard[easy] = hard[easy - 1] = False
    capital = _IS_UPPER[data]
    capital[upper - 1] = True
    data[upper] += 32
    some = np.flatnonzero(size)
    code = np.zeros(len(low), np.uint64)
    code[some] = hashes_of(data, first[some], size[some])
    begins = data[np.minimum(first, len(data) - 1)]
    flags[(size > 0) & capital[np.minimum(first, len(data) - 1)]] |= _CAPITAL
    flags[some[np.isin(code[some], _UNIT_CODES)]] |= _UNIT
    text = lambda i: raw[first[i] : first[i] + size[i]].decode()
    number = np.flatnonzero((size > 0) & _STARTS_NUMBER[begins])
    distinct, one, back = np.unique(code[number], return_index=True, return_inverse=True)
    is_number = np.array([_NUMBER.fullmatch(text(i).lower()) is not None for i in number[one].tolist()], bool)
    yes = number[is_number[back]] if len(distinct) else number
    flags[yes] = flags[yes] & ~_UNIT | _NUM
    seen = np.concatenate([[0], np.cumsum(hard, dtype=np.int32)])
    slow = some[seen[first[some] + size[some]] > seen[first[some]]]
    if len(slow):
        cores = [text(i) for i in slow.tolist()]
        distinct_cores = list(set(cores))
        place = {c: i for i, c in enumerate(distinct_cores)}
        codes, lower = _codes(distinct_cores), [c.lower() for c in distinct_cores]
        kinds = np.array(
            [(_CAPITAL if c[0].isupper() else 0) | (_NUM if _NUMBER.fullmatch(w) else _UNIT if w in UNITS else 0) for c, w in zip(distinct_cores, lower, strict=True)]
        )
        at = np.array([place[c] for c in cores])
        code[slow] = codes[at]
        flags[slow] = flags[slow] & ~(_CAPITAL | _NUM | _UNIT) | kinds[at]
    return raw, doc, first, size, code, flags


def _hashes(code: np.ndarray, n: int) -> np.ndarray:
    code = mixed(code)
    h = np.zeros(n, np.uint64)
    for i in range(WORDS):
        h += code[i : n + i] * _PLACE[i]
    return mixed(h)


def _found(docs: list[str], wanted: np.ndarray | None) -> Iterator[tuple[int, int, int, int, list[str]]]:
    """(document number, window position, form, hash, slot values) of windows whose hash is wanted."""
    raw, doc, at, size, code, flags = tokens(docs)
    start = np.ones(len(code), bool)
    start[1:] = ((flags[:-1] & _END) > 0) | (doc[1:] != doc[:-1])
    keep = (flags & _SKIP) == 0
    code, flags, doc, at, size, start = code[keep], flags[keep], doc[keep], at[keep], size[keep], start[keep]
    n = len(code) - WORDS + 1
    if n < 1:
        return
    number = (flags & _NUM) > 0
    unit = np.zeros(len(code), bool)
    unit[1:] = ((flags[1:] & _UNIT) > 0) & number[:-1] & (doc[1:] == doc[:-1])
    name = ((flags & _CAPITAL) > 0) & ~start & ~number & ~unit
    holds, worded, plain = np.zeros(n, bool), np.zeros(n, bool), np.zeros(n, bool)
    for i in range(WORDS):
        holds |= name[i : n + i]
        worded |= ~(number | unit)[i : n + i]
        plain |= ~(number | unit | name)[i : n + i]
    whole = doc[:n] == doc[WORDS - 1 :]
    first = np.searchsorted(doc, np.arange(len(docs)))
    code[number], code[unit] = _NUM_CODE, _UNIT_CODE
    folded = _hashes(code, n)
    code[name] = _NAME_CODE
    slot = number | unit
    for h, ok, slot, form in (
        (folded, whole & worded, slot, np.where(holds, FOLDED, PLAIN)),
        (_hashes(code, n), whole & holds & plain, slot | name, np.full(n, NAMED)),
    ):
        if wanted is not None and len(wanted):
            ok = ok & (wanted[np.minimum(np.searchsorted(wanted, h), len(wanted) - 1)] == h)
        elif wanted is not None:
            ok = np.zeros(n, bool)
        signed = h.view(np.int64)
        for i in np.flatnonzero(ok).tolist():
            d = int(doc[i])
            values = [raw[at[j] : at[j] + size[j]].decode() for j in range(i, i + WORDS) if slot[j]]
            yield d, i - int(first[d]), int(form[i]), int(signed[i]), values


def windows(df: DataFrame, key: str, wanted: np.ndarray | None = None) -> DataFrame:
    """(id, pos, form, hash, slots) of every template window, or of the wanted ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(b.schema.get_field_index("id")).to_pylist()
            low = 0
            for docs in grouped(texts(b)):
                rows = [(ids[low + d], *r) for d, *r in _found(docs, wanted)]
                low += len(docs)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r[0] for r in rows], pa.int64()),
                        pa.array([r[1] for r in rows], pa.int64()),
                        pa.array([r[2] for r in rows], pa.int32()),
                        pa.array([r[3] for r in rows], pa.int64()),
                        pa.array([r[4] for r in rows], pa.list_(pa.string())),
                    ],
                    names=["id", "pos", "form", "hash", "slots"],
                )

    small_batches(df.sparkSession)
    named = df.select(F.col(key).cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    return named.where("id is not null").mapInArrow(run, "id long, pos long, form int, hash long, slots array<string>")


def _same(pair: Column) -> Column:
    return F.lower(pair["theirs"]) == F.lower(pair["ours"])


def leaks(docs: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """One row for each leaked pair (by share or a long run): doc_id, item_id, coverage (0 to 1) and the item's slot values found."""
    items = windows(benchmark, "item_id").toDF("item_id", "item_pos", "item_form", "hash", "item_slots")
    few = items.select("hash").distinct().limit(SIFT + 1).toPandas()["hash"].to_numpy(np.int64)
    wanted = np.sort(few.view(np.uint64)) if len(few) <= SIFT else None
    own = windows(docs, "doc_id", wanted).toDF("doc_id", "pos", "form", "hash", "slots")
    # windows without names on both sides belong to either template's diagonal
    plain = (F.col("form") == PLAIN) & (F.col("item_form") == PLAIN)
    forms = F.when(plain, F.array(F.lit(NAMED), F.lit(FOLDED))).otherwise(
        F.array(F.when(F.col("form") == NAMED, NAMED).otherwise(FOLDED))
    )
    met = own.join(items, "hash").select(
        "doc_id", "item_id", "item_pos", F.explode(forms).alias("form"), (F.col("pos") - F.col("item_pos")).alias("diagonal"),
        F.arrays_zip(F.col("item_slots").alias("theirs"), F.col("slots").alias("ours")).alias("pairs"),
    )
    lines = met.groupBy("doc_id", "item_id", "form", "diagonal").agg(
        F.collect_set("item_pos").alias("covered"), F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs"),
        F.array_sort(F.collect_set(F.when(F.forall("pairs", _same), F.col("item_pos")))).alias("verbatim"),
    )
    # sorted distinct positions i to i + k are consecutive where they lie k apart
    k = LONG - WORDS
    long = F.exists(F.arrays_zip(F.col("verbatim").alias("low"), F.slice("verbatim", k + 1, 1 << 30).alias("high")), lambda p: p["high"] - p["low"] == k)
    low = F.transform("pairs", lambda p: F.struct(F.lower(p["theirs"]).alias("theirs"), F.lower(p["ours"]).alias("ours")))
    lines = lines.withColumn("alike", F.when(F.col("form") == FOLDED, F.array_distinct(low)).otherwise(F.col("pairs")))
    one_to_one = (F.size(F.array_distinct("alike.theirs")) == F.size("alike")) & (
        F.size(F.array_distinct("alike.ours")) == F.size("alike")
    )
    sizes = items.groupBy("item_id").agg(F.countDistinct("item_pos").alias("n"))
    # of a diagonal that contradicts itself, a long run counts alone
    lines = lines.select(
        "doc_id", "item_id", long.alias("long"), one_to_one.alias("fits"),
        F.when(one_to_one, F.col("covered")).otherwise(F.col("verbatim")).alias("covered"),
        F.when(one_to_one, F.col("pairs")).otherwise(F.filter("pairs", _same)).alias("pairs"),
    )
    return (
        lines.where("fits or long")
        .groupBy("doc_id", "item_id")
        .agg(
            F.size(F.array_distinct(F.flatten(F.collect_set("covered")))).alias("k"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("pairs.ours")))).alias("slot_values"),
            F.max("long").alias("long"),
        )
        .join(sizes, "item_id")
        .withColumn("coverage", F.col("k") / F.col("n"))
        .where((F.col("coverage") >= share) | F.col("long"))
        .select("doc_id", "item_id", "coverage", "slot_values")
    )
