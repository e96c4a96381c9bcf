"""Secrets: key patterns, and strings whose characters are spread as random ones are.

Kinds of the base: assign (a secret's name, then a value of 6 characters or more), access (a cloud
access key), hex (24 or more). The method adds kind ``entropy``: candidate strings are runs of 20 or
more characters of keys; per character class (hex, base32, base36, base64) a window of 20 characters slides
over them, and a candidate is reported if some window of that class has a Shannon entropy of at least the
class's limit. One window of evenly random characters stays below it with a chance of about 6 % (hex) or
1 % (the others; quantiles of 400,000 windows each). Names made of words or numbers with separators, and
account numbers whose check digits hold, need ``STRONG``, more than most names have. One fold slides over
a candidate for all classes: it keeps the counts of the window's characters and updates the sum of ``n log2 n``
by the character that leaves and the one that enters, so its time grows with the candidate's length. The allow-list suppresses candidates that are known to be harmless: no digit
or no letter, digests that are named as such, UUIDs, counting sequences, placeholders.

DataFrame functions only, one narrow pass.

Defined cases: a null text is empty and has no spans; repeated rows each get their own result; an
empty table gives an empty result; extra columns pass through.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textforge.llm.frames import fresh, table
from textforge.llm.pii import mod97
from textforge.llm.spans import joined, labelled, matches, number_of

ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*+[:=]\x20*+["']?([A-Za-z0-9+/_.=-]++)"""
#: Runs are maximal, so a least length in the pattern drops exactly the shorter ones.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
BASE = ("assign", "access", "hex")

WINDOW = 20
#: Character class to its pattern and the least entropy, in bits, of a window.
CLASSES = {
    "hex": ("^[0-9a-fA-F]+$", 3.05),
    "base32": ("^(?:[A-Z2-7]+|[a-z2-7]+)$", 3.34),
    "base36": ("^(?:[A-Z0-9]+|[a-z0-9]+)$", 3.40),
    "base64": ("^[A-Za-z0-9+/_=-]+$", 3.64),
}
#: The least entropy, in bits, of a window of what may be a name or an account number; hex keeps its limit.
STRONG = 3.95
_PART = "(?:[A-Z]?[a-z]+|[A-Z]+|[0-9]+)"
NAME = f"^{_PART}(?:[+/_=-]+{_PART})+$"
ACCOUNT = "^[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}$"
ALLOWED = (
    "^[^0-9]*$",
    "^[^A-Za-z]*$",
    r"^[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    r"(?i)^(?:sha(?:1|256|384|512)|md5)[-_=]",
    r"(?i)example|placeholder|changeme|x{6}|0123456789|abcdefgh",
)


_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: Runs of these characters; a window lies in a class if one of the class's runs covers it.
_RUNS = {
    "hex": "0123456789abcdefABCDEF",
    "upper32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "lower32": "abcdefghijklmnopqrstuvwxyz234567",
    "upper36": "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789",
    "lower36": "abcdefghijklmnopqrstuvwxyz0123456789",
}
_RUNS_OF = {"hex": ("hex",), "base32": ("upper32", "lower32"), "base36": ("upper36", "lower36")}
#: Counts take 5 bits each, 12 to a number; sums of n log2 n are whole numbers of 2^-40, so nothing drifts.
_PER_NUMBER, _UNIT = 12, 1 << 40
_NUMBERS = -(-len(_ALPHABET) // _PER_NUMBER)
_WEIGHTS = [round(n * math.log2(n) * _UNIT) if n else 0 for n in range(WINDOW + 2)]
#: Of a character's code: the bits of its count's place, the number that has it, the character, its runs.
_NUMBER_AT, _CHARACTER_AT, _RUNS_AT = 6, 9, 16


def _codes(value: Column) -> Column:
    """Each character's code: where its count is kept, and which runs it belongs to."""
    codes = [0] * 128
    for i, c in enumerate(_ALPHABET):
        runs = sum(1 << n for n, own in enumerate(_RUNS.values()) if c in own)
        codes[ord(c)] = 5 * (i % _PER_NUMBER) | i // _PER_NUMBER << _NUMBER_AT | i << _CHARACTER_AT | runs << _RUNS_AT
    known = F.lit(codes)
    return F.transform(F.split(value, ""), lambda c: F.get(known, F.ascii(c)))


def _bits(code: Column, at: int, n: int) -> Column:
    return F.shiftright(code, at).bitwiseAND((1 << n) - 1)


def windows(value: Column, result: Callable[[dict[str, Column]], Column]) -> Column:
    """``result`` of the highest entropy of each class's windows (null where none lies in the class).

    One fold over the characters. Its state holds the counts of the window's characters and the sum of
    ``n log2 n``; a step takes the character that leaves and the one that enters, and nothing else.
    """
    length = F.length(value)
    codes = F.slice(_codes(value), F.lit(1), length)
    before = F.concat(F.array_repeat(F.lit(-1), WINDOW), codes)
    steps = F.slice(F.arrays_zip(codes.alias("new"), before.alias("old")), F.lit(1), length)
    weights, none = F.lit(_WEIGHTS), F.lit(0).cast("bigint")

    def number(state: Column, code: Column) -> Column:
        """How often the window has a character."""
        which, chosen = _bits(code, _NUMBER_AT, 3), state[f"c{_NUMBERS - 1}"]
        for i in range(_NUMBERS - 1):
            chosen = F.when(which == i, state[f"c{i}"]).otherwise(chosen)
        return F.call_function("shiftright", chosen, _bits(code, 0, 6)).bitwiseAND(31).cast("int")

    def step(state: Column, x: Column) -> Column:
        new, old = x["new"], x["old"]
        full = old >= 0
        n_out, n_in = number(state, old), number(state, new)
        less = F.when(full, F.get(weights, n_out) - F.get(weights, n_out - 1)).otherwise(none)
        more = F.get(weights, n_in + 1) - F.get(weights, n_in)
        # A character that leaves and enters again changes nothing.
        same = _bits(new, _CHARACTER_AT, 7) == _bits(old, _CHARACTER_AT, 7)
        total = F.when(full & same, state["total"]).otherwise(state["total"] - less + more)
        one = F.lit(1).cast("bigint")
        enters = F.call_function("shiftleft", one, _bits(new, 0, 6))
        leaves = F.when(full, F.call_function("shiftleft", one, _bits(old, 0, 6))).otherwise(none)
        into, out_of = _bits(new, _NUMBER_AT, 3), _bits(old, _NUMBER_AT, 3)
        counts = [
            state[f"c{i}"] + F.when(into == i, enters).otherwise(none) - F.when(out_of == i, leaves).otherwise(none)
            for i in range(_NUMBERS)
        ]
        runs = {
            name: F.when(_bits(new, _RUNS_AT + n, 1) == 1, state[f"run_{name}"] + 1).otherwise(F.lit(0))
            for n, name in enumerate(_RUNS)
        }
        place = state["place"] + 1
        inside = {kind: F.greatest(*(runs[r] for r in own)) if len(own) > 1 else runs[own[0]] for kind, own in _RUNS_OF.items()}
        inside["base64"] = place
        least = {kind: F.least(state[f"least_{kind}"], F.when(inside[kind] >= WINDOW, total)) for kind in CLASSES}
        return F.struct(
            place.alias("place"),
            total.alias("total"),
            *(n.alias(f"c{i}") for i, n in enumerate(counts)),
            *(n.alias(f"run_{name}") for name, n in runs.items()),
            *(n.alias(f"least_{kind}") for kind, n in least.items()),
        )

    zero = F.struct(
        F.lit(0).alias("place"),
        none.alias("total"),
        *(none.alias(f"c{i}") for i in range(_NUMBERS)),
        *(F.lit(0).alias(f"run_{name}") for name in _RUNS),
        *(F.lit(None).cast("bigint").alias(f"least_{kind}") for kind in CLASSES),
    )

    def entropy(state: Column, kind: str) -> Column:
        """The least sum is the highest entropy."""
        return F.round(F.lit(math.log2(WINDOW)) - state[f"least_{kind}"] / F.lit(float(WINDOW * _UNIT)), 9)

    return F.aggregate(steps, zero, step, lambda s: result({kind: entropy(s, kind) for kind in CLASSES}))


def best_entropy(value: Column) -> Column:
    """The highest entropy of the windows that lie in each class, as a struct."""
    return windows(value, lambda found: F.struct(*(e.alias(kind) for kind, e in found.items())))


def random_looking(value: Column) -> Column:
    harmless = F.lit(False)
    for pattern in ALLOWED:
        harmless = harmless | value.rlike(pattern)

    def high(found: dict[str, Column]) -> Column:
        known = value.rlike(NAME) | (value.rlike(ACCOUNT) & mod97(value))
        out = found["hex"] >= CLASSES["hex"][1]
        for kind, (_, limit) in CLASSES.items():
            if kind != "hex":
                # A name or an account number is looked at only if the window is above the lower limit.
                out = F.coalesce(out, F.lit(False)) | ((found[kind] >= limit) & ((found[kind] >= STRONG) | ~known))
        return F.coalesce(out, F.lit(False))

    return F.when(harmless, F.lit(False)).otherwise(windows(value, high))


def _assign_holds(value: Column) -> Column:
    return F.length(F.regexp_extract(value, ASSIGN, 2)) >= 6


def find_spans(text: Column) -> dict[str, Column]:
    return {
        "assign": matches(text, ASSIGN, text.rlike("(?i)password|passwd|secret|token|api_?key"), _assign_holds),
        "access": matches(text, ACCESS, F.contains(text, F.lit("AKIA"))),
        "hex": matches(text, HEX, text.rlike(HEX)),
        "entropy": matches(text, CANDIDATE, text.rlike(CANDIDATE), random_looking),
    }


def add_secrets(docs: DataFrame, result: str, text_col: str = "text") -> DataFrame:
    """``docs`` with an array column of spans: rank, start, stop, kind, by start and kind."""
    whole = fresh(docs, "whole")
    kept = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.withColumn(whole, F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    found = find_spans(F.col(whole))
    names = {kind: fresh(rows, f"found_{kind}") for kind in found}
    rows = rows.withColumns({names[kind]: spans for kind, spans in found.items()})
    each = F.concat(*[labelled(kind, rank, F.col(names[kind])) for rank, kind in enumerate(found)])
    by_start = F.transform(
        F.array_sort(
            F.transform(each, lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["stop"].alias("stop"), s["kind"].alias("kind")))
        ),
        lambda s: F.struct(s["rank"].alias("rank"), s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind")),
    )
    return rows.select(*kept, by_start.alias(result))


def op8_secrets(spark, sf_dir: str) -> DataFrame:
    found = add_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"), "found")
    base = F.filter("found", lambda s: s["rank"] < len(BASE))
    return found.select("doc_id", "found", joined(base).alias("base"), joined(F.col("found")).alias("spans")).select(
        "doc_id",
        *[number_of(F.col("found"), kind).alias(f"n_{kind}") for kind in BASE],
        F.sha2("base", 256).alias("base_sha256"),
        "spans",
    )
