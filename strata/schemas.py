"""Fixed contracts: column lists, table schemas, domain values.

These values must equal the source system's contracts for results to match,
so they are stated here plainly, in their natural order.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: landing CSV contracts (canonical column names) -----------
EXPECTED_COLUMNS = {
    "pedido": ["Id_Unidade", "Id_Pedido", "Tipo_Pedido", "Data_Pedido", "Vlr_Pedido",
               "Endereco_Entrega", "Taxa_Entrega", "Status"],
    "item_pedido": ["Id_Pedido", "Id_Item_Pedido", "Id_Produto", "Qtd", "Vlr_Item", "Observacao"],
}

# --- fixed values: dimension contracts (relational extract) ------------------
DIMENSION_COLUMNS = {
    "produto": ["Id_Produto", "Nome_Produto"],
    "unidade": ["Id_Unidade", "Nome_Unidade", "Id_Estado"],
    "estado": ["Id_Estado", "Id_Pais", "Nome_Estado"],
    "pais": ["Id_Pais", "Nome_Pais"],
}

# --- fixed values: domain standardisation (upper-cased, trimmed input) -------
STATUS_VALUES = {"PENDENTE": "PENDENTE", "FINALIZADO": "FINALIZADO", "CANCELADO": "CANCELADO"}
TIPO_PEDIDO_VALUES = {"LOJA ONLINE": "ONLINE", "LOJA FISICA": "FISICA", "LOJA FÍSICA": "FISICA"}
ACCEPTED_STATUS = ["PENDENTE", "FINALIZADO", "CANCELADO"]
ACCEPTED_TIPO = ["ONLINE", "FISICA"]

# --- fixed values: ingestion log / quarantine vocabulary ---------------------
LOG_STATUSES = ["STARTED", "LOADED", "SKIPPED_DUPLICATE", "REJECTED", "ERROR"]
REASON_BAD_NAME = "NOME_FORA_DO_PADRAO"
REASON_INVALID = "VALIDACAO_FALHOU"
MSG_EMPTY = "arquivo vazio"
MSG_BAD_NAME = "nome fora do padrão"
MAX_ERRORS_PER_FILE = 20
LOG_ERROR_CHARS = 1000
QUARANTINE_DETAIL_CHARS = 5000
DEFAULT_DELIMITER = ";"
DELIMITERS = [",", ";", "|", "\t"]

# --- fixed values: windows and thresholds ------------------------------------
LOOKBACK_DAYS = 7
COMPLETENESS_DAYS = 14
FRESHNESS_WARN_HOURS = 26
FRESHNESS_ERROR_HOURS = 50
DIVERGENCE_TOLERANCE = "0.01"
BUSINESS_TZ = "America/Sao_Paulo"

MONEY = T.DecimalType(38, 9)

_S, _L, _TS, _D = T.StringType(), T.LongType(), T.TimestampType(), T.DateType()


def _struct(cols):
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in cols])


RAW_LINEAGE = [("_ingestion_ts", _TS, True), ("_source_file", _S, True), ("_file_hash", _S, True),
               ("_file_version", _L, True), ("_id_unidade", _S, True), ("_batch_id", _S, True),
               ("_line_no", _L, True), ("_load_id", _S, True)]

RAW_CSV_SCHEMAS = {
    tipo: _struct([(c, _S, True) for c in cols] + RAW_LINEAGE)
    for tipo, cols in EXPECTED_COLUMNS.items()
}

RAW_DIMENSION_SCHEMAS = {
    name: _struct([(c, _S, True) for c in cols]
                  + [("_snapshot_date", _D, True), ("_ingestion_ts", _TS, True), ("_batch_id", _S, True)])
    for name, cols in DIMENSION_COLUMNS.items()
}

INGESTION_LOG_SCHEMA = _struct([
    ("file_path", _S, False), ("file_hash", _S, True), ("id_unidade", _L, True), ("tipo", _S, True),
    ("data_ref", _D, True), ("file_version", _L, True), ("row_count", _L, True), ("status", _S, False),
    ("batch_id", _S, True), ("error", _S, True), ("processed_at", _TS, False)])

QUARANTINE_SCHEMA = _struct([
    ("file_path", _S, False), ("file_hash", _S, True), ("id_unidade", _L, True), ("tipo", _S, True),
    ("data_ref", _D, True), ("reason", _S, False), ("details", _S, True), ("batch_id", _S, True),
    ("quarantined_at", _TS, False)])

EXPECTED_UNITS_SCHEMA = _struct([("id_unidade", _L, True), ("ativa", T.BooleanType(), True)])
