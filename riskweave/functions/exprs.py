"""Scalar expressions that carry the reference's null and edge contract.

Each helper returns a ``Column``; all stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "EPS", "col_of", "email_domain", "email_local", "neq_null_true", "eps_ratio", "clip_lower",
    "seconds_between", "as_int", "tokens", "word_count", "first_token_lower", "name_in_email",
    "clean_number", "rate_of", "error_rate_name", "parse_ts_lenient",
]

# Fixed value: the reference's ratio guard, /(d + 1e-6).
EPS = 1e-6


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def email_domain(email="email") -> Column:
    """Part after the first '@'; NULL e-mail (and, our deviation, no '@') -> 'missing'."""
    e = col_of(email)
    return F.coalesce(F.get(F.split(e, "@"), 1), F.lit("missing"))


def email_local(email="email") -> Column:
    """Lower-cased part before the first '@'; NULL e-mail -> ''."""
    e = col_of(email)
    return F.coalesce(F.lower(F.get(F.split(e, "@"), 0)), F.lit(""))


def neq_null_true(a, b) -> Column:
    """Object-column ``a != b``: any NULL operand counts as different (null vs null too)."""
    return F.coalesce(col_of(a) != col_of(b), F.lit(True))


def eps_ratio(num, den) -> Column:
    return col_of(num) / (col_of(den) + F.lit(EPS))


def clip_lower(c, lo: float = 0.0) -> Column:
    """``clip(lower=lo)`` keeping NULL as NULL (greatest() would skip it)."""
    x = col_of(c)
    return F.when(x.isNull(), F.lit(None)).otherwise(F.greatest(x, F.lit(lo)))


def seconds_between(later, earlier) -> Column:
    """Exact difference in seconds (microsecond resolution) as DOUBLE."""
    return (F.unix_micros(col_of(later)) - F.unix_micros(col_of(earlier))) / F.lit(1e6)


def as_int(pred) -> Column:
    return col_of(pred).cast("int")


def tokens(s) -> Column:
    """Python ``str.split()``: whitespace-separated, no empty tokens."""
    return F.filter(F.split(col_of(s), r"\s+"), lambda t: t != F.lit(""))


def word_count(s) -> Column:
    return F.size(tokens(s))


def first_token_lower(s) -> Column:
    """Lower-cased first token of a non-blank string, else NULL."""
    return F.lower(F.get(tokens(s), 0))


def name_in_email(email_name, holder) -> Column:
    """Any holder token longer than 2 chars is a substring of the e-mail name.

    The e-mail name is lower-cased, the holder tokens are not (reference
    behaviour: an upper-case holder never matches).
    """
    en = col_of(email_name)
    toks = F.filter(tokens(holder), lambda t: F.length(t) > 2)
    return F.coalesce(F.exists(toks, lambda t: F.instr(en, t) > 0), F.lit(False)).cast("int")


def clean_number(c) -> Column:
    """Matrix-step scrub: NULL, NaN and +/-inf become 0."""
    x = col_of(c).cast("double")
    return F.when(x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))), F.lit(0.0)).otherwise(x)


def rate_of(pred) -> Column:
    """Share of rows where ``pred`` holds; NULL predicate counts as false."""
    return F.avg(F.coalesce(col_of(pred), F.lit(False)).cast("double"))


def error_rate_name(group: str) -> str:
    return f"error_{group.replace(' ', '_')}_rate"


def parse_ts_lenient(c) -> Column:
    """``to_datetime(errors='coerce', utc=True)``: unparseable -> NULL."""
    x = col_of(c)
    return F.try_to_timestamp(x.cast("string"))
