"""Declared schemas and key lists of every table the pipeline reads or writes.

Column names are the output contract of the original pipeline's tables and are
kept verbatim (Portuguese); function names in this package are English.
"""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, BooleanType, DoubleType, LongType, StringType,
                               StructField, StructType, TimestampNTZType)

# ---- bronze: one JSON document per API poll ---------------------------------
VEHICLE = StructType([
    StructField("p", LongType()),        # vehicle id
    StructField("a", BooleanType()),     # accessible (not carried to silver)
    StructField("ta", StringType()),     # capture time, ISO-8601 UTC text
    StructField("py", DoubleType()),     # latitude
    StructField("px", DoubleType()),     # longitude
])
LINE = StructType([
    StructField("c", StringType()),      # line code on the sign
    StructField("cl", LongType()),       # line id
    StructField("sl", LongType()),       # direction 1 / 2
    StructField("lt0", StringType()),    # destination sign
    StructField("lt1", StringType()),    # origin sign
    StructField("qv", LongType()),       # vehicles located on the line
    StructField("vs", ArrayType(VEHICLE)),
])
BRONZE = StructType([
    StructField("hr", StringType()),     # HH:mm of the snapshot
    StructField("l", ArrayType(LINE)),
])
# reception partition columns of the landing layout
BRONZE_PARTITIONS = ("recv_date", "recv_hour")

# ---- silver: one row per vehicle per snapshot --------------------------------
SILVER_COLUMNS = ("data_ref", "hora_ref", "cod_onibus", "sentido_linha", "let_cod_linha",
                  "let_destino", "let_origem", "timestamp_pos", "latitude_pos",
                  "longitude_pos", "id_linha", "qtde_onibus")
SILVER = StructType([
    StructField("data_ref", StringType()),
    StructField("hora_ref", StringType()),
    StructField("cod_onibus", LongType()),
    StructField("sentido_linha", LongType()),
    StructField("let_cod_linha", StringType()),
    StructField("let_destino", StringType()),
    StructField("let_origem", StringType()),
    StructField("timestamp_pos", TimestampNTZType()),
    StructField("latitude_pos", DoubleType()),
    StructField("longitude_pos", DoubleType()),
    StructField("id_linha", LongType()),
    StructField("qtde_onibus", LongType()),
])
# silver and every hourly gold table are partitioned by the *event* hour
HOUR_PARTITIONS = ("data_ref", "hora_id_ref")

_LABELS = [StructField("sentido_linha", LongType()), StructField("let_cod_linha", StringType()),
           StructField("let_destino", StringType()), StructField("let_origem", StringType())]

# ---- gold facts ---------------------------------------------------------------
TOTAL_POR_LINHA = StructType([StructField("data_ref", StringType()), StructField("hora_ref", StringType()),
                              StructField("id_linha", LongType()), *_LABELS,
                              StructField("qtde_onibus", LongType())])
TOTAL_GERAL = StructType([StructField("data_ref", StringType()), StructField("hora_ref", StringType()),
                          StructField("qtde_onibus", LongType())])
MEDIA_POR_LINHA = StructType([StructField("data_ref", StringType()), StructField("hora_id_ref", StringType()),
                              StructField("id_linha", LongType()), *_LABELS,
                              StructField("qtde_onibus", LongType())])
MEDIA_GERAL = StructType([StructField("data_ref", StringType()), StructField("hora_id_ref", StringType()),
                          StructField("qtde_onibus", LongType())])
LINHAS_META = StructType([StructField("data_ref", StringType()), StructField("hora_id_ref", StringType()),
                          StructField("id_linha", LongType()), *_LABELS,
                          StructField("meta_qtde_onibus", LongType()),
                          StructField("avg_qtde_onibus", LongType())])
TOTAL_LINHAS = StructType([StructField("data_ref", StringType()), StructField("hora_id_ref", StringType()),
                           StructField("qtde_linhas", LongType())])
# target (dimension) table: per hour of day and line
META = StructType([StructField("hora_id_ref", StringType()), StructField("id_linha", LongType()), *_LABELS,
                   StructField("meta_qtde_onibus", LongType())])


class Table:
    """A gold/reference table: schema, primary key, hour column, non-key columns."""

    def __init__(self, name: str, schema: StructType, keys: tuple[str, ...], hour_col: str):
        self.name, self.schema, self.keys, self.hour_col = name, schema, keys, hour_col

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]

    @property
    def measures(self) -> list[str]:
        return [c for c in self.columns if c not in self.keys]

    def __repr__(self) -> str:
        return f"Table({self.name})"


TABLES = {t.name: t for t in [
    Table("total_onibus_por_linha", TOTAL_POR_LINHA, ("data_ref", "hora_ref", "id_linha"), "hora_ref"),
    Table("total_onibus_geral", TOTAL_GERAL, ("data_ref", "hora_ref"), "hora_ref"),
    Table("media_onibus_por_linha", MEDIA_POR_LINHA, ("data_ref", "hora_id_ref", "id_linha"), "hora_id_ref"),
    Table("media_onibus_geral", MEDIA_GERAL, ("data_ref", "hora_id_ref"), "hora_id_ref"),
    Table("linhas_atingida_meta", LINHAS_META, ("data_ref", "hora_id_ref", "id_linha"), "hora_id_ref"),
    Table("total_linhas_atingida_meta", TOTAL_LINHAS, ("data_ref", "hora_id_ref"), "hora_id_ref"),
    Table("linhas_abaixo_meta", LINHAS_META, ("data_ref", "hora_id_ref", "id_linha"), "hora_id_ref"),
    Table("total_linhas_abaixo_meta", TOTAL_LINHAS, ("data_ref", "hora_id_ref"), "hora_id_ref"),
    Table("meta_onibus_por_linha", META, ("hora_id_ref", "id_linha"), "hora_id_ref"),
    Table("baseline_media_onibus_por_linha", MEDIA_POR_LINHA, ("data_ref", "hora_id_ref", "id_linha"),
          "hora_id_ref"),
]}


def assert_schema(df, expected: StructType, *, exact_order: bool = False) -> None:
    """Fail when a frame's columns/types drift from the declared schema."""
    got = {f.name: f.dataType for f in df.schema.fields}
    missing = [f.name for f in expected.fields if f.name not in got]
    wrong = [(f.name, got[f.name], f.dataType) for f in expected.fields
             if f.name in got and got[f.name] != f.dataType]
    if missing or wrong:
        raise ValueError(f"schema mismatch: missing={missing} wrong_types={wrong}")
    if exact_order and [f.name for f in df.schema.fields] != [f.name for f in expected.fields]:
        raise ValueError("schema column order differs")
