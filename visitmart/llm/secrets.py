"""Secret scans: known forms by pattern, and strings of high entropy by a sliding window.

All of it is DataFrame functions over one row at a time: no shuffle, no Python. Patterns are cut
out by ``split`` and ``regexp_extract_all``, places are running sums of what lies between.

Candidate strings are runs of 20 characters or more of the base-64 alphabet. Over each of them a window of
20 characters is slid; its character counts change by one character in and one out per step, and
with them the sum of c * log2(c), held in whole numbers so that nothing drifts. A window's entropy
is log2(20) less a twentieth of that sum. A candidate with a window whose entropy reaches the bound of its
character class is a span, unless the allow list knows it or a pattern has found it already.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A name that announces a secret, and the value after it (second group).
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LENGTH = 12
# Runs of one class: a shorter run never holds a match, so the least length can stand in the pattern.
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"

WINDOW = 20
CANDIDATE = rf"[A-Za-z0-9+/_-]{{{WINDOW},}}"
HEX_DIGITS = "0123456789abcdefABCDEF"
BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
#: Bits per character that a window must reach, by class.
ENTROPY_HEX = 3.0
ENTROPY_BASE64 = 3.8
#: Candidates in which one of these is found are no secrets.
ALLOWED = (
    "(?i:example|sample|dummy|placeholder|changeme|change_me|your_|your-)",
    "(?i:abcdefgh|01234567|12345678)",
    "^[0-9]+$",
)

KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_base64")

#: A long candidate is scanned in parts of so many windows, cut with an overlap: the windows are the same.
PART = 4096
#: Running sums are taken in groups of so many, as appending to an array copies it.
GROUP = 512


def running(sizes: Column) -> Column:
    """The sum of the elements before each one, for an array of longs."""

    def sums(values: Column, start: Column) -> Column:
        none = F.array().cast("array<bigint>")
        return F.aggregate(
            values,
            F.struct(start.alias("total"), none.alias("sums")),
            lambda state, value: F.struct(
                (state["total"] + value).alias("total"), F.concat(state["sums"], F.array(state["total"])).alias("sums")
            ),
            lambda state: state["sums"],
        )

    zero = F.lit(0).cast("long")
    last = F.floor((F.greatest(F.size(sizes), F.lit(1)) - 1) / GROUP).cast("int")
    groups = F.transform(F.sequence(F.lit(0), last), lambda at: F.slice(sizes, at * GROUP + 1, GROUP))
    totals = F.transform(groups, lambda group: F.aggregate(group, zero, lambda total, value: total + value))
    pairs = F.arrays_zip(groups.alias("group"), sums(totals, zero).alias("start"))
    return F.flatten(F.transform(pairs, lambda pair: sums(pair["group"], pair["start"])))


def _length(text: Column) -> Column:
    return F.length(text).cast("long")


def _with_matches(frame: DataFrame, text: str, pattern: str, name: str) -> DataFrame:
    """Adds ``name`` (array of the matches), ``name_between`` (the text around them) and ``name_at`` (places of the pieces between).

    A match begins where the piece before it ends.
    """
    found, between = f"{name}_found", f"{name}_between"
    frame = frame.withColumn(found, F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0)))
    pieces = F.when(F.size(found) > 0, F.split(F.col(text), pattern, -1)).otherwise(F.array(F.col(text)))
    frame = frame.withColumn(between, pieces)
    lengths = F.transform(F.col(between), lambda piece, at: _length(piece) + F.coalesce(_length(F.get(F.col(found), at)), F.lit(0)))
    return frame.withColumn(f"{name}_at", running(lengths))


def _spans(name: str, kind: str, keep: Column | None = None) -> Column:
    """Structs of (start, rank, end, kind) of the matches that ``_with_matches`` found; ``keep`` is a flag for each."""
    spans = F.transform(
        F.col(f"{name}_found"),
        lambda match, at: F.struct(
            (F.get(F.col(f"{name}_at"), at) + _length(F.get(F.col(f"{name}_between"), at))).alias("start"),
            F.lit(KINDS.index(kind)).alias("rank"),
            (F.get(F.col(f"{name}_at"), at) + _length(F.get(F.col(f"{name}_between"), at)) + _length(match)).alias("end"),
            F.lit(kind).alias("kind"),
        ),
    )
    return spans if keep is None else F.filter(spans, lambda span, at: F.get(keep, at))


def entropy_reaches(text: Column, alphabet: str, bits: Column, window: int = WINDOW) -> Column:
    """Whether a window of the text, all of whose characters are of the alphabet, has that entropy.

    False for texts shorter than a window.
    """
    scale = 1 << 40
    weight = F.array(*[F.lit(round(c * math.log2(c) * scale) if c else 0).cast("long") for c in range(window + 1)])
    most = F.floor((math.log2(window) - bits) * window * scale)
    # Counts lie side by side in longs, so that a step writes a few numbers and not one for each character.
    width = window.bit_length()
    held = 60 // width
    words = -(-len(alphabet) // held)
    one = F.lit(1).cast("long")

    def of_part(part: Column) -> Column:
        codes = F.transform(F.split(part, ""), lambda c: F.call_function("instr", F.lit(alphabet), c) - 1)

        def unit(code: Column) -> Column:
            return F.call_function("shiftleft", one, (code % held) * width)

        def count(counts: Column, code: Column) -> Column:
            word = F.get(counts, F.floor(code / held).cast("int"))
            return F.call_function("shiftright", word, (code % held) * width).bitwiseAND((1 << width) - 1).cast("int")

        def step(state: Column, at: Column) -> Column:
            into = F.get(codes, at)
            out = F.when(at >= window, F.get(codes, at - window))
            more, less = count(state["counts"], into), count(state["counts"], out)
            change = F.get(weight, more + 1) - F.get(weight, more) + F.coalesce(F.get(weight, less - 1) - F.get(weight, less), F.lit(0))
            total = F.when(into == out, state["total"]).otherwise(state["total"] + change)

            def counted(word: Column, n: Column) -> Column:
                entered = F.when(F.floor(into / held) == n, word + unit(into)).otherwise(word)
                return F.when(F.floor(out / held) == n, entered - unit(out)).otherwise(entered)

            after = F.struct(
                F.transform(state["counts"], counted).alias("counts"),
                total.alias("total"),
                ((at >= window - 1) & (total <= most)).alias("reached"),
            )
            return F.when(state["reached"], state).otherwise(after)

        start = F.struct(
            F.array_repeat(F.lit(0).cast("long"), words).alias("counts"),
            F.lit(0).cast("long").alias("total"),
            F.lit(False).alias("reached"),
        )
        reached = F.aggregate(F.sequence(F.lit(0), F.length(part) - 1), start, step, lambda state: state["reached"])
        # Entropy is at most the log of the number of different characters.
        return (F.size(F.array_distinct(F.split(part, ""))) >= F.pow(F.lit(2.0), bits) - 1e-9) & reached

    starts = F.sequence(F.lit(1), F.length(text) - window + 1, F.lit(PART))
    parts = F.transform(starts, lambda at: F.substring(text, at, F.lit(PART + window - 1)))
    return F.when(F.length(text) >= window, F.exists(parts, of_part)).otherwise(False)


def _entropy_kind(candidate: Column, bounds: dict[str, float], allowed: tuple[str, ...]) -> Column:
    """The kind a candidate is a span of, or NULL."""
    known = F.lit(False)
    for pattern in (*allowed, HEX, ACCESS):
        known |= candidate.rlike(pattern)
    hexadecimal = candidate.rlike(f"^[{HEX_DIGITS}]+$")
    mixed = candidate.rlike("[0-9]") & candidate.rlike("[A-Za-z]")
    kind = F.when(hexadecimal, F.lit("entropy_hex")).otherwise(F.lit("entropy_base64"))
    bits = F.when(hexadecimal, F.lit(bounds["entropy_hex"])).otherwise(F.lit(bounds["entropy_base64"]))
    return F.when(mixed & ~known, F.when(entropy_reaches(candidate, BASE64, bits), kind))


def find_secrets(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    entropy_hex: float = ENTROPY_HEX,
    entropy_base64: float = ENTROPY_BASE64,
    allowed: tuple[str, ...] = ALLOWED,
) -> DataFrame:
    """(doc_id, spans) for every row; a span is (start, rank, end, kind), in code points, the end exclusive.

    Kinds: ``assign`` (a name like ``password``, a sign and a value of 12 characters or more; the span is the whole match),
    ``access`` (key ids), ``hex`` (16 lower-case hexadecimal digits or more), and what entropy adds:
    ``entropy_hex`` (digits of both cases) and ``entropy_base64``. Spans of one kind don't overlap; they are sorted by start,
    then kind in this order, which ``rank`` counts. Entropy spans hold letters and digits, lie outside
    all matches of the assign pattern, whatever their value's length, and hold no match of the other two;
    ``allowed`` are patterns of harmless candidates and never touch the first three kinds.

    Null and empty texts have no spans. Rows repeated, or sharing an id, are judged each by itself; ids may be of any type.
    Bytes that are no UTF-8 become U+FFFD. No rows in, no rows out.
    """
    text = F.make_valid_utf8(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    for name, pattern in (("assign", ASSIGN), ("access", ACCESS), ("hex", HEX)):
        rows = _with_matches(rows, "text", pattern, name)
    long_value = F.transform(
        F.regexp_extract_all(F.col("text"), F.lit(ASSIGN), F.lit(1)), lambda value: F.length(value) >= ASSIGN_LENGTH
    )
    rows = rows.withColumn("assign_long", F.when(F.size("assign_found") > 0, long_value).otherwise(F.array().cast("array<boolean>")))

    bounds = {"entropy_hex": entropy_hex, "entropy_base64": entropy_base64}

    def in_piece(piece: Column, at: Column) -> Column:
        """Entropy spans of one piece between assign matches."""
        found = F.regexp_extract_all(piece, F.lit(CANDIDATE), F.lit(0))
        between = F.split(piece, CANDIDATE, -1)
        kinds = F.transform(found, lambda candidate: _entropy_kind(candidate, bounds, allowed))
        lengths = F.transform(between, lambda text, n: _length(text) + F.coalesce(_length(F.get(found, n)), F.lit(0)))
        parts = F.arrays_zip(
            kinds.alias("kind"),
            F.transform(found, _length).alias("length"),
            F.slice(F.transform(between, _length), 1, F.size(found)).alias("gap"),
            F.slice(running(lengths), 1, F.size(found)).alias("before"),
        )
        start = F.get(F.col("assign_at"), at)
        spans = F.transform(
            F.filter(parts, lambda part: part["kind"].isNotNull()),
            lambda part: F.struct(
                (start + part["before"] + part["gap"]).alias("start"),
                F.when(part["kind"] == KINDS[3], 3).otherwise(4).alias("rank"),
                (start + part["before"] + part["gap"] + part["length"]).alias("end"),
                part["kind"].alias("kind"),
            ),
        )
        return F.when(piece.rlike(CANDIDATE), spans)

    rows = rows.withColumn("added", F.filter(F.transform("assign_between", in_piece), lambda spans: spans.isNotNull()))
    spans = F.concat(
        _spans("assign", "assign", F.col("assign_long")), _spans("access", "access"), _spans("hex", "hex"), F.flatten("added")
    )
    return rows.select("doc_id", F.array_sort(spans).alias("spans"))


def listed(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
