from strata.functions.columns import (  # noqa: F401
    blank_to_null, clean, differs, mask_text, money_product, parse_date_br,
    parse_decimal_br, safe_int, standardize, standardize_status, standardize_tipo_pedido,
    normalize_header_name,
)
