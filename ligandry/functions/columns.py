"""Column expressions: measurements, tokens, ratios, bounds and failure reasons. All stay inside the JVM."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Brackets, two-digit ring closures, two-letter halogens, else single characters.
TOKEN_PATTERN = r"(?s)(\[[^\]]*\]|%[0-9]{2}|Br|Cl|.)"
START, STOP, PAD = "^", "$", "*"


def no_nan(c: Column) -> Column:
    """NaN as null: NaN sorts above every number here, but fails every comparison in the data model."""
    return F.when(F.isnan(c.cast("double")), None).otherwise(c.cast("double"))


def minus_log10(value: Column, c: float = 1e9) -> Column:
    """Null for a value that is null, NaN or not positive."""
    value = no_nan(value)
    return F.when(value > 0, -F.log10(value / F.lit(c)))


def mentions(text: Column, pattern: str) -> Column:
    """Case-insensitive search; null text mentions nothing."""
    return F.coalesce(text.rlike(f"(?i){pattern}"), F.lit(False))


def tokenize(smiles: Column) -> Column:
    """Start, tokens, stop; an empty array for null or empty text."""
    found = F.concat(F.array(F.lit(START)), F.regexp_extract_all(smiles, F.lit(TOKEN_PATTERN), 1), F.array(F.lit(STOP)))
    return F.when(F.length(smiles) > 0, found).otherwise(F.array().cast("array<string>"))


def untokenize(tokens: Column) -> Column:
    """Text of the tokens before the first stop, without starts."""
    stop = F.array_position(tokens, STOP)
    before = F.when(stop > 0, F.slice(tokens, F.lit(1), F.greatest(stop.cast("int") - 1, F.lit(0)))).otherwise(tokens)
    return F.array_join(F.filter(before, lambda t: t != START), "")


def encode(tokens: Column, ids: Column, unknown: int | None = None) -> Column:
    """Ids of tokens through a map column; unknown ones get that id, or are left out."""
    found = F.transform(tokens, lambda t: F.coalesce(F.try_element_at(ids, t), F.lit(unknown).cast("int")))
    return F.filter(found, lambda i: i.isNotNull())


def decode(ids: Column, tokens: Column) -> Column:
    return F.transform(ids, lambda i: F.try_element_at(tokens, i))


def safe_ratio(n: Column, d: Column) -> Column:
    return F.when(d > 0, n / d).otherwise(F.lit(0.0))


def within(c: Column, low: float | None, high: float | None) -> Column:
    """Inclusive range; null and NaN are never inside."""
    c = no_nan(c)
    ok = c.isNotNull()
    if low is not None:
        ok = ok & (c >= F.lit(float(low)))
    if high is not None:
        ok = ok & (c <= F.lit(float(high)))
    return F.coalesce(ok, F.lit(False))


def known_tokens(tokens: Column, vocabulary: Iterable[str]) -> Column:
    return F.coalesce(F.size(F.array_except(tokens, F.lit(sorted(vocabulary)))) == 0, F.lit(False))


def no_rare_tokens(tokens: Column, rare: Iterable[str]) -> Column:
    rare = sorted(rare)
    return F.coalesce(~F.arrays_overlap(tokens, F.lit(rare)), F.lit(False)) if rare else F.lit(True)


def failure_reasons(bounds: Mapping[str, tuple[float | None, float | None]], unknown: Column | None = None, rare: Column | None = None) -> Column:
    """'prop:low', 'prop:high' in the order of bounds, then token reasons, joined by '; '."""
    parts = []
    for name, (low, high) in bounds.items():
        c = no_nan(F.col(name))
        if low is not None:
            parts.append(F.when(c < low, f"{name}:low"))
        if high is not None:
            parts.append(F.when(c > high, f"{name}:high"))
    if unknown is not None:
        parts.append(F.when(unknown, "tokens:unknown"))
    if rare is not None:
        parts.append(F.when(rare, "tokens:rare"))
    return F.concat_ws("; ", *parts) if parts else F.lit("")


def on_bits(vector: Column) -> Column:
    """Sign bits of a vector packed into 64-bit words, as many as its length needs; null for null."""
    zero = F.lit(0).cast("long")
    bit = lambda k: lambda acc, i: acc.bitwiseOR(F.when(F.get(vector, i + 64 * k) > 0, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(zero))
    words = F.transform(F.sequence(F.lit(0), F.ceil(F.size(vector) / 64).cast("int") - 1), lambda k: F.aggregate(F.sequence(F.lit(0), F.lit(63)), zero, bit(k)))
    return F.when(F.size(vector) > 0, words).when(vector.isNotNull(), F.array().cast("array<long>"))


def token_atom_ratio(tokens: Column, atoms: Column) -> Column:
    """Tokens for each heavy atom; null without atoms."""
    return F.when(atoms > 0, tokens / atoms)


def tanimoto(a: Column, b: Column) -> Column:
    """Similarity of two packed fingerprints; 0 where neither has a bit."""
    zero = F.lit(0).cast("long")
    both = F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseAND(y)).cast("long")), zero, lambda s, x: s + x)
    either = F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseOR(y)).cast("long")), zero, lambda s, x: s + x)
    return safe_ratio(both, either)
