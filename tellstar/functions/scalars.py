"""Column-level business rules."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the pricing contract: rates are USD per one million tokens, catalog
# prices are cents per token (x 1e4 converts), tokens times rate are divided by 1e6.
RATE_TYPE = "decimal(14,6)"
TOKEN_TYPE = "decimal(12,0)"
COST_TYPE = "decimal(38,12)"
CENTS_PER_TOKEN_TO_USD_PER_MTOK = 10000
PER_TOKEN = Decimal("0.000001")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def infer_mechanism(explicit: Column | str, retriever: Column | str) -> Column:
    """Explicit traversal mechanism, else inferred from the retriever.

    Uses SQL LIKE, so ``_`` in the pattern is a single-character wildcard, as in the
    original CASE expression."""
    r = _col(retriever)
    inferred = (
        F.when(r == "vector", "dense")
        .when(r.like("graph_neighborhood%"), "neighborhood")
        .when(r == "graph_sparqlgen", "sparqlgen")
        .when(r == "closed_book", "none")
    )
    return F.coalesce(_col(explicit), inferred)


def hop_count(type_id: Column | str) -> Column:
    """Question reasoning depth from the type naming convention; order matters (P10)."""
    t = _col(type_id)
    return (
        F.when(t.like("%3plus_hop%"), 3)
        .when(t.like("%2hop%"), 2)
        .when(t.like("%1hop%"), 1)
        .when(t.like("%0hop%"), 0)
        .cast("int")
    )


def split_part_or_empty(c: Column | str, delim: str, n: int) -> Column:
    """``split_part(coalesce(c, ''), delim, n)``: '' when the part is missing."""
    return F.split_part(F.coalesce(_col(c), F.lit("")), F.lit(delim), F.lit(n))


def nullif_empty(c: Column | str) -> Column:
    """``nullif(c, '')``."""
    c = _col(c)
    return F.when(c != "", c)


def usd_per_mtok(cents_per_token_text: Column) -> Column:
    """Catalog price (cents per token, any JSON number text) -> USD per 1M tokens.

    The stored rate has six decimals; a price with more digits than that fails the job rather
    than being rounded."""
    cents = cents_per_token_text.cast("decimal(24,12)")
    exact = cents * F.lit(CENTS_PER_TOKEN_TO_USD_PER_MTOK)
    lossless = (exact.cast(RATE_TYPE) == exact) & (cents == cents_per_token_text.cast("decimal(38,24)"))
    return F.when(lossless | cents.isNull(), exact.cast(RATE_TYPE)).otherwise(
        F.raise_error(F.concat(F.lit("price needs more than six decimals per million tokens: "), cents_per_token_text)))


def token_cost(*pairs: tuple[Column | str, Column | str]) -> Column:
    """Sum of tokens x rate over (tokens, rate) pairs, divided by 1e6.

    Tokens are coalesced to 0; rates are not, so a missing rate yields NULL cost.
    Typed as decimal(12,0) x decimal(14,6) so the product never loses scale."""
    total = None
    for tokens, rate in pairs:
        term = F.coalesce(_col(tokens), F.lit(0)).cast(TOKEN_TYPE) * _col(rate)
        total = term if total is None else total + term
    return (total * F.lit(PER_TOKEN)).cast(COST_TYPE)


def coalesce_sum(*cols: Column | str, cast: str | None = None) -> Column:
    """``coalesce(a,0) + coalesce(b,0) + ...``."""
    out = None
    for c in cols:
        term = F.coalesce(_col(c), F.lit(0))
        out = term if out is None else out + term
    return out.cast(cast) if cast else out


def passed_flag(is_passed: Column | str) -> Column:
    """True -> 1; false or NULL (ungraded/errored) -> 0."""
    return F.coalesce(_col(is_passed), F.lit(False)).cast("int")


def guarded_ratio(num: Column | str, den: Column | str) -> Column:
    """num / den, NULL (not infinity, not an error) when den is 0 (P25)."""
    d = _col(den)
    return F.when(d > 0, _col(num).cast("double") / d.cast("double"))


def starts_with_or_false(c: Column | str, prefix: str) -> Column:
    """``str.startswith(prefix, na=False)``."""
    return F.coalesce(_col(c).startswith(prefix), F.lit(False))


def not_in_or_null(c: Column | str, values: list[str]) -> Column:
    """pandas ``~s.isin(values)``: a NULL value is kept (F1), unlike SQL NOT IN."""
    return ~F.coalesce(_col(c).isin(values), F.lit(False))


def is_local_provider(provider: Column | str) -> Column:
    """``provider = 'ollama'``; NULL provider gives NULL (P20)."""
    return _col(provider) == F.lit("ollama")
