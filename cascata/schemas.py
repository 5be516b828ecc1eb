"""Contracts of the layers: closed domains, table schemas and fixed texts."""

from __future__ import annotations

from pyspark.sql import types as T

# Closed domains of the data contract.
CONTENT_TYPES = ["Artigo", "Curso", "Podcast", "Vídeo"]
CATEGORIES = [
    "Banco de Dados",
    "Business Intelligence",
    "Ciência de Dados",
    "DevOps & Cloud",
    "Engenharia de Dados",
    "Inteligência Artificial",
    "Programação & Software",
    "Segurança & Governança",
]
LEVELS = ["Avançado", "Básico", "Intermediário"]
INTERACTION_TYPES = [
    "avaliação",
    "compartilhamento",
    "conclusão",
    "curtida",
    "início",
    "visualização",
]
ACCENTED = "ÁÀÂÃÄáàâãäÉÈÊËéèêëÍÌÎÏíìîïÓÒÔÕÖóòôõöÚÙÛÜúùûüÇç"
UNACCENTED = "AAAAAaaaaaEEEEeeeeIIIIiiiiOOOOOoooooUUUUuuuuCc"

CATALOG_COLUMNS = [
    "conteudo_id", "titulo", "tipo", "categoria", "nivel",
    "carga_horaria_min", "data_publicacao", "descricao", "autor",
]
INTERACTION_COLUMNS = [
    "usuario_id", "conteudo_id", "tipo_interacao", "data_hora",
    "tempo_consumido", "percentual_conclusao", "avaliacao_atribuida",
]
COMMENT_COLUMNS = ["usuario_id", "conteudo_id", "avaliacao", "comentario", "tags", "data"]
AUDIT_COLUMNS = ["origem", "arquivo_origem", "data_hora_ingestao", "execucao_id"]


def text_schema(columns: list[str]) -> T.StructType:
    """Bronze keeps every source column as text."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


QUARANTINE_COLUMNS = [
    "id", "registro_id", "origem", "regra_violada", "mensagem", "execucao_id", "payload_original", "status",
]


def quarantine_schema() -> T.StructType:
    """``id`` grows with every entry; the payload is the raw row as JSON text."""
    return T.StructType([
        T.StructField(c, T.LongType() if c == "id" else T.StringType()) for c in QUARANTINE_COLUMNS
    ])


def bronze_schema(columns: list[str]) -> T.StructType:
    return text_schema([*columns, *AUDIT_COLUMNS]).add("ordem", T.LongType())


SILVER_CONTENT = T.StructType([
    T.StructField("conteudo_id", T.LongType()),
    T.StructField("titulo", T.StringType()),
    T.StructField("tipo", T.StringType()),
    T.StructField("categoria", T.StringType()),
    T.StructField("nivel", T.StringType()),
    T.StructField("carga_horaria_min", T.LongType()),
    T.StructField("data_publicacao", T.DateType()),
    T.StructField("descricao", T.StringType()),
    T.StructField("autor", T.StringType()),
])
SILVER_INTERACTION = T.StructType([
    T.StructField("usuario_id", T.LongType()),
    T.StructField("conteudo_id", T.LongType()),
    T.StructField("tipo_interacao", T.StringType()),
    T.StructField("data_hora", T.TimestampNTZType()),
    T.StructField("tempo_consumido", T.LongType()),
    T.StructField("percentual_conclusao", T.DecimalType(5, 2)),
    T.StructField("avaliacao_atribuida", T.LongType()),
])
SILVER_COMMENT = T.StructType([
    T.StructField("usuario_id", T.LongType()),
    T.StructField("conteudo_id", T.LongType()),
    T.StructField("avaliacao", T.LongType()),
    T.StructField("comentario", T.StringType()),
    T.StructField("tags", T.ArrayType(T.StringType())),
    T.StructField("data", T.DateType()),
])
QUALITY_RESULT = T.StructType([
    T.StructField("execucao_id", T.StringType()),
    T.StructField("fonte", T.StringType()),
    T.StructField("teste", T.StringType()),
    T.StructField("dimensao", T.StringType()),
    T.StructField("formula", T.StringType()),
    T.StructField("valor", T.DoubleType()),
    T.StructField("limite", T.DoubleType()),
    T.StructField("operador", T.StringType()),
    T.StructField("severidade", T.StringType()),
    T.StructField("aprovado", T.BooleanType()),
    T.StructField("acao", T.StringType()),
    T.StructField("mensagem", T.StringType()),
])
