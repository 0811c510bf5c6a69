"""Operator 3: document fingerprints as invertible Bloom lookup tables, in DataFrame functions only.

A text's paragraphs (its lines, cut on after every CUT characters) are hashed to 48 bits. Their distinct
digests, dealt into groups of about LOAD by value, fill one table a group: cells that hold a count and the XOR of
the digests with their 16-bit checks. Tables of two texts subtract cell by cell, what both hold cancels,
and peeling cells of a single digest recovers the digests that differ. A table that peeling doesn't empty
is made again with other places and twice the cells, for both texts, until it does.

A fingerprint holds for each group of its text the first table that peels to the group's own digests. So a
fingerprint gives all digests back, and tables of any size can be made from it; `near_*` depends on the two
fingerprints alone. It is (a + b - d) / (a + b + d) for a and b digests, d of them recovered as differing.

Work grows with the length of a text: digests are sorted once and cut into groups as runs.

Defined cases: a null text counts as empty; two texts without paragraphs are alike (1.0), one without
and one with are not (0.0); rows of one doc_id are ordered by the hash of their text; null ids come last;
a sole document is its own next one; an empty table gives an empty table; other columns are not used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Characters after which a line is cut.
CUT = 128
#: Digests of a group's table on average, and cells of each of a first table's three parts.
LOAD, CELLS = 16, 10
#: Tables tried for a group, each with twice the cells of the one before, and rounds of peeling.
TRIES, ROUNDS = 12, 24
#: Documents of a stretch of ids, and most stretches.
STRETCH, STRETCHES = 2048, 1 << 16
#: Seed of a digest's check; tables use the number of their try.
CHECK = -1


def _let(value: Column, use) -> Column:
    """`use(value)` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def paragraphs(text: Column) -> Column:
    """Distinct 48-bit digests of lines, cut on after every CUT characters."""
    found = F.regexp_extract_all(text, F.lit(rf"[^\n]{{1,{CUT}}}"), F.lit(0))
    return F.array_distinct(F.transform(found, lambda s: F.shiftrightunsigned(F.xxhash64(s), 16)))


def _cell(n: Column, v: Column) -> Column:
    return F.struct(n.cast("int").alias("n"), v.alias("v"))


def _check(k: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(k, F.lit(CHECK)), 48)


def _places(k: Column, cells: Column, attempt: Column) -> Column:
    """A digest and its check as one number, and its cell within each of the three parts of the table."""

    def spread(h: Column) -> Column:
        at = [F.pmod(F.shiftright(h, 21 * p), cells).cast("int").alias(f"p{p}") for p in range(3)]
        return F.struct(F.shiftleft(k, 16).bitwiseOR(_check(k)).alias("v"), *at)

    return _let(F.xxhash64(k, attempt), spread)


def table(digests: Column, cells: Column, attempt: Column) -> Column:
    """The cells of a digest array, 3 * cells of them."""
    zero = _cell(F.lit(0), F.lit(0).cast("long"))

    def filled(own: Column) -> Column:
        def part(p: int) -> Column:
            def cell(j: Column) -> Column:
                return F.aggregate(
                    own, zero, lambda s, x: F.when(x[f"p{p}"] == j, _cell(s.n + 1, s.v.bitwiseXOR(x.v))).otherwise(s)
                )

            return F.transform(F.sequence(F.lit(0), cells - 1), cell)

        return F.concat(*map(part, range(3)))

    return _let(F.transform(digests, lambda k: _places(k, cells, attempt)), filled)


def subtract(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda p, q: _cell(p.n - q.n, p.v.bitwiseXOR(q.v)))


def peel(difference: Column, cells: Column, attempt: Column) -> Column:
    """The digests in one of the subtracted tables only, or null where peeling doesn't empty the difference."""

    def step(s: Column, _: Column) -> Column:
        # digest and sign as one number: distinct numbers are cheap, distinct structs are not
        single = F.array_distinct(
            F.transform(
                F.filter(s.t, lambda z: (F.abs(z.n) == 1) & (z.v.bitwiseAND(0xFFFF) == _check(F.shiftrightunsigned(z.v, 16)))),
                lambda z: F.shiftrightunsigned(z.v, 16) * 2 + F.when(z.n < 0, 1).otherwise(0),
            )
        )
        placed = F.transform(
            single,
            lambda v: F.struct((F.lit(1) - 2 * v.bitwiseAND(1)).cast("int").alias("n"), _places(F.shiftright(v, 1), cells, attempt).alias("x")),
        )

        def take(found: Column) -> Column:
            def part(p: int) -> Column:
                def without(z: Column, j: Column) -> Column:
                    return F.aggregate(
                        found, z, lambda w, u: F.when(u.x[f"p{p}"] == j, _cell(w.n - u.n, w.v.bitwiseXOR(u.x.v))).otherwise(w)
                    )

                return F.transform(F.slice(s.t, cells * p + 1, cells), without)

            got = F.concat(s.got, F.transform(found, lambda u: F.shiftrightunsigned(u.x.v, 16)))
            left = F.struct(F.concat(*map(part, range(3))).alias("t"), got.alias("got"), F.lit(False).alias("end"))
            ended = F.struct(s.t.alias("t"), s.got.alias("got"), F.lit(True).alias("end"))
            return F.when(F.size(found) == 0, ended).otherwise(left)

        return F.when(s.end, s).otherwise(_let(placed, take))

    start = F.struct(difference.alias("t"), F.array().cast("array<bigint>").alias("got"), F.lit(False).alias("end"))
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(ROUNDS)), start, step,
        lambda s: F.when(~F.exists(s.t, lambda z: (z.n != 0) | (z.v != 0)), s.got),
    )


def settled(a: Column, b: Column) -> Column:
    """t, the first difference table of two digest arrays that peels, and got, the digests it yields."""

    def again(s: Column, attempt: Column) -> Column:
        def tried(cells: Column) -> Column:
            difference = subtract(table(a, cells, attempt), table(b, cells, attempt))
            return _let(difference, lambda t: F.struct(t.alias("t"), peel(t, cells, attempt).alias("got")))

        cells = F.call_function("shiftleft", F.lit(CELLS), attempt)
        return F.when(s.got.isNotNull(), s).otherwise(_let(cells, tried))

    start = F.struct(
        F.lit(None).cast("array<struct<n:int,v:bigint>>").alias("t"), F.lit(None).cast("array<bigint>").alias("got")
    )
    # each try has fresh places, and one of a few digests fails once in cells ** 3: TRIES in a row don't; if they did, the query stops
    never = F.raise_error(F.lit("a fingerprint table can't be peeled"))
    return F.aggregate(
        F.sequence(F.lit(0), F.lit(TRIES - 1)), start, again, lambda s: F.when(s.got.isNotNull(), s).otherwise(never)
    )


def groups(a: Column, b: Column) -> Column:
    """The digests of both texts in groups of about LOAD: runs of the sorted digests, in time that grows with their number."""
    count = F.ceil((F.size(a) + F.size(b)) / LOAD).cast("long")

    def signed(v: Column, side: int) -> Column:
        return F.transform(v, lambda k: k * 2 + side)

    def run(all_: Column) -> Column:
        def group(i: Column) -> Column:
            return F.shiftright(F.shiftright(F.get(all_, i), 17) * count, 32)

        last = F.size(all_)
        ends = F.filter(F.sequence(F.lit(1), last), lambda i: (i == last) | (group(i) != group(i - 1)))

        def cut(to: Column) -> Column:
            def of(i: Column) -> Column:
                begin = F.when(i == 0, F.lit(0)).otherwise(F.get(to, i - 1))
                own = F.slice(all_, begin + 1, F.get(to, i) - begin)
                return _let(own, lambda z: F.struct(*(_side(z, s).alias(n) for n, s in (("a", 0), ("b", 1)))))

            return F.transform(F.sequence(F.lit(0), F.size(to) - 1), of)

        return _let(ends, cut)

    none = F.array().cast("array<struct<a:array<bigint>,b:array<bigint>>>")
    return F.when(F.size(a) + F.size(b) == 0, none).otherwise(_let(F.sort_array(F.concat(signed(a, 0), signed(b, 1))), run))


def _side(own: Column, side: int) -> Column:
    return F.transform(F.filter(own, lambda v: v.bitwiseAND(1) == side), lambda v: F.shiftright(v, 1))


def differing(a: Column, b: Column) -> Column:
    """The digests that one of two digest arrays alone holds, by subtracting and peeling their tables."""
    return F.flatten(F.transform(groups(a, b), lambda g: settled(g.a, g.b).got))


def likeness(a: Column, b: Column) -> Column:
    both = F.size(a) + F.size(b)
    near = _let(F.size(differing(a, b)), lambda d: (both - d) / (both + d))
    return F.when(both == 0, F.lit(1.0)).otherwise(near).cast("double")


def printed(digests: Column) -> Column:
    """A fingerprint as text: the number of digests, `-`, then each group's table in base64, joined by `.`.

    A cell has nine bytes: its count modulo 256, six bytes of digests, two of checks."""

    def cell(z: Column) -> Column:
        return F.concat(F.lpad(F.hex(F.pmod(z.n, F.lit(256))), 2, "0"), F.lpad(F.hex(z.v), 16, "0"))

    def spelled(g: Column) -> Column:
        cells = F.transform(settled(g.a, g.b).t, cell)
        return F.regexp_replace(F.base64(F.unhex(F.array_join(cells, ""))), r"\s", "")

    none = F.array().cast("array<bigint>")
    return F.concat(F.size(digests).cast("string"), F.lit("-"), F.array_join(F.transform(groups(digests, none), spelled), "."))


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text and next_text, the text that follows in descending doc_id, the first after the last.

    Ids are cut into stretches of about STRETCH rows by quantiles, so no window spans the table, however ids
    are spread; rows without an id are cut by the hash of their text. Each stretch's last row gets the text
    of the first row of the next stretch, found by a join of at most STRETCHES + 257 stretches."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    n = own.select("doc_id").count()
    parts = max(1, min(STRETCHES, -(-n // STRETCH)))
    bounds = None
    if parts > 1:
        shares = [i / parts for i in range(1, parts)]
        bounds = own.agg(F.percentile_approx("doc_id", shares, max(10_000, 4 * parts))).first()[0]
    bounds = sorted(set(bounds or []))
    stretch = F.lit(0)
    if bounds:
        known = F.lit(bounds)
        # binary search: how many bounds lie below the id
        span = F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi"))

        def halve(s: Column, _: Column) -> Column:
            middle = F.shiftright(s.lo + s.hi, 1)
            below = F.get(known, middle) < F.col("doc_id")
            return F.when(s.lo >= s.hi, s).otherwise(
                F.struct(F.when(below, middle + 1).otherwise(s.lo).alias("lo"), F.when(below, s.hi).otherwise(middle).alias("hi"))
            )

        steps = F.sequence(F.lit(0), F.lit(len(bounds).bit_length()))
        stretch = F.aggregate(steps, span, halve, lambda s: s.lo)
    tie = F.xxhash64("text")
    no_id = (-F.lit(129) - F.shiftright(tie, 56)).cast("int")
    placed = own.select("*", tie.alias("tie"), F.when(F.col("doc_id").isNull(), no_id).otherwise(stretch).alias("stretch"))
    inner = Window.partitionBy("stretch").orderBy(F.col("doc_id").desc_nulls_last(), "tie", "text")
    # the head of a stretch: its highest id (the hash alone where ids are null), then the first hash, then text
    rank = F.struct(F.coalesce(-F.col("doc_id"), F.lit(0)).alias("id"), "tie")
    heads = placed.groupBy("stretch").agg(F.min(rank).alias("head"))
    order = Window.orderBy(F.desc("stretch"))
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = heads.select(
        F.col("stretch").alias("before"),
        F.coalesce(F.lead("stretch").over(order), F.first("stretch").over(whole)).alias("stretch"),
    ).join(heads, "stretch")
    first = (
        placed.join(F.broadcast(after), "stretch").where(rank == F.col("head"))
        .groupBy(F.col("before").alias("stretch")).agg(F.min("text").alias("head_text"))
    )
    return (
        placed.withColumn("lead_text", F.lead("text").over(inner))
        .join(first, "stretch", "left")
        .select("doc_id", "text", F.coalesce("lead_text", "head_text").alias("next_text"))
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited (the edited text), fingerprint, edited_fingerprint, near_edited, near_next."""
    n = F.char_length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - third), F.substring(F.col("next_text"), F.lit(1), third))
    rows = with_next(docs).withColumn("n_chars", n.cast("long")).withColumn("edited", edited)
    # arrays make one expression of all fingerprints and one of all comparisons: the plan stays small
    sides = F.transform(F.array("text", "edited", "next_text"), paragraphs)
    rows = rows.withColumn("digests", sides)
    own, new, following = (F.get("digests", F.lit(i)) for i in range(3))
    pairs = F.array(*(F.struct(own.alias("x"), other.alias("y")) for other in (new, following)))
    rows = rows.withColumn("shown", F.transform(F.array(own, new), printed)).withColumn(
        "near", F.transform(pairs, lambda p: likeness(p.x, p.y))
    )
    return rows.select(
        "doc_id", "n_chars", "edited",
        F.get("shown", F.lit(0)).alias("fingerprint"), F.get("shown", F.lit(1)).alias("edited_fingerprint"),
        F.get("near", F.lit(0)).alias("near_edited"), F.get("near", F.lit(1)).alias("near_next"),
    )
