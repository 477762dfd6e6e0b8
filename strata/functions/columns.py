"""Column -> Column helpers.  All native expressions (no Python UDF), so they
stay inside whole-stage code generation and run on every executor."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata import schemas

# Every BMP character Python's ``str.isspace`` accepts (what the source
# system's trim removes), plus the byte-order mark.  Built by rule, used by a
# native character-set trim (no regex, stays in generated code).
WHITE_SPACE = "".join(chr(i) for i in range(0x10000) if chr(i).isspace()) + "\ufeff"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean(c) -> Column:
    """Trim all Unicode white space (and a stray BOM) from both ends."""
    return F.trim(_c(c), F.lit(WHITE_SPACE))


def blank_to_null(c) -> Column:
    """``nullif(trim(x), '')``."""
    return F.nullif(clean(c), F.lit(""))


def safe_int(c) -> Column:
    """``safe_cast(x as int64)``: integers only; '12.7', '', 'abc' -> NULL."""
    return clean(c).try_cast("bigint")


def parse_decimal_br(c, precision: int = 38, scale: int = 9) -> Column:
    """Brazilian or plain decimal text -> decimal; unparsable -> NULL.

    With a comma, dots are thousands separators and the comma is the decimal
    mark; without one the text is taken as it is.
    """
    x = clean(c)
    text = F.when(F.contains(_c(c), F.lit(",")),
                  F.replace(F.replace(x, F.lit("."), F.lit("")), F.lit(","), F.lit(".")))\
        .otherwise(x)
    return text.try_cast(f"decimal({precision},{scale})")


def parse_date_br(c) -> Column:
    """``d/M/yyyy`` first, ISO ``yyyy-M-d`` second, on the first 10 characters."""
    head = clean(F.substring(clean(c), 1, 10))
    # Same result as trying both formats in turn: a text with '/' can only
    # match the first, one without it only the second (and no parse is tried
    # that must fail).
    return F.when(F.contains(head, F.lit("/")), F.try_to_date(head, "d/M/yyyy")) \
        .otherwise(F.try_to_date(head, "yyyy-M-d"))


def standardize(c, mapping: dict[str, str]) -> Column:
    """Map ``upper(trim(x))`` through a fixed dictionary; anything else -> NULL."""
    key = F.upper(clean(c))
    out = None
    for k, v in mapping.items():
        out = F.when(key == F.lit(k), F.lit(v)) if out is None else out.when(key == F.lit(k), F.lit(v))
    return out


def standardize_status(c) -> Column:
    return standardize(c, schemas.STATUS_VALUES)


def standardize_tipo_pedido(c) -> Column:
    return standardize(c, schemas.TIPO_PEDIDO_VALUES)


def money_product(qty, price) -> Column:
    """``qty * price`` at scale 9: decimal(18,0) * decimal(19,9) -> decimal(38,9).

    A value that does not fit raises; it never becomes a quiet NULL that sums would leave out.
    """
    q, p = _c(qty).try_cast("decimal(18,0)"), _c(price).try_cast("decimal(19,9)")
    lost = (_c(qty).isNotNull() & q.isNull()) | (_c(price).isNotNull() & p.isNull())
    message = F.concat(F.lit("money_product out of range: "), _c(qty).cast("string"), F.lit(" * "), _c(price).cast("string"))
    return F.when(lost, F.raise_error(message).cast("decimal(38,9)")).otherwise(q * p)


def differs(a, b, tol: str = schemas.DIVERGENCE_TOLERANCE) -> Column:
    """``abs(a - b) > tol`` with a decimal literal tolerance; NULL if any side is NULL."""
    return F.abs(_c(a) - _c(b)) > F.lit(tol).cast("decimal(10,2)")


def mask_text(c, key: str) -> Column:
    """Hide personal text for non-privileged readers.  The full SHA-256
    digest under a secret key keeps equal values joinable; without the key a
    guessed value can't be looked up."""
    digest = F.sha2(F.encode(F.concat(F.lit(key), F.lit("|"), _c(c)), "UTF-8"), 256)
    return F.when(_c(c).isNull(), F.lit(None).cast("string")).otherwise(F.concat(F.lit("***"), digest))


def normalize_header_name(c) -> Column:
    """Header cell -> canonical form: trim, drop BOM, inner white space -> '_'."""
    return F.regexp_replace(clean(c), r"[\s\p{Z}\x{85}\x{1C}-\x{1F}]+", "_")
