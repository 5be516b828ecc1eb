"""Bronze to Silver: typed rows, ordered rules, and the split into Silver and quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cascata.functions import casts, text
from cascata.operators import rules
from cascata.operators.rules import Rule
from cascata.operators.skew import lookup, mark_repeats
from cascata.schemas import (
    AUDIT_COLUMNS,
    CATALOG_COLUMNS,
    CATEGORIES,
    COMMENT_COLUMNS,
    CONTENT_TYPES,
    INTERACTION_COLUMNS,
    INTERACTION_TYPES,
    LEVELS,
    SILVER_COMMENT,
    SILVER_CONTENT,
    SILVER_INTERACTION,
)

ORDER = "ordem"


def outside(column: str, domain: list[str]) -> Column:
    return F.col(column).isNull() | ~F.col(column).isin(domain)


# Rule codes in the order they are tried, with the message of each.
CONTENT_MESSAGES = {
    "ID_INVALIDO": "conteudo_id ausente ou nao numerico na origem",
    "DUPLICADO": "conteudo_id duplicado no Bronze; mantida apenas a primeira ocorrencia",
    "TIPO_FORA_DO_DOMINIO": "tipo fora do dominio oficial (Artigo, Curso, Podcast, Video)",
    "CATEGORIA_FORA_DO_DOMINIO": "categoria fora do dominio oficial das 8 categorias",
    "NIVEL_FORA_DO_DOMINIO": "nivel fora do dominio oficial (Basico, Intermediario, Avancado)",
}
INTERACTION_MESSAGES = {
    "USUARIO_INVALIDO": "usuario_id ausente, nao numerico ou nao positivo na origem",
    "REFERENCIA_INEXISTENTE": "conteudo_id ausente, nao numerico ou sem correspondencia em silver.conteudo",
    "DUPLICADO": "chave de negocio (usuario_id, conteudo_id, data_hora) duplicada no Bronze; mantida apenas a primeira ocorrencia",
    "TIPO_INTERACAO_FORA_DO_DOMINIO": "tipo_interacao fora do dominio oficial",
    "DATA_INVALIDA": "data_hora ilegivel ou fora do formato esperado",
    "PERCENTUAL_FORA_DA_FAIXA": "percentual_conclusao ilegivel ou fora da faixa 0-100",
    "AVALIACAO_FORA_DA_FAIXA": "avaliacao_atribuida fora da faixa 1-5",
}
COMMENT_MESSAGES = {
    "USUARIO_INVALIDO": "usuario_id ausente, nao numerico ou nao positivo na origem",
    "REFERENCIA_INEXISTENTE": "conteudo_id ausente, nao numerico ou sem correspondencia em silver.conteudo",
    "DUPLICADO": "chave de negocio (usuario_id, conteudo_id, data) duplicada no Bronze; mantida apenas a primeira ocorrencia",
    "DATA_INVALIDA": "data ilegivel ou fora do formato esperado",
    "AVALIACAO_FORA_DA_FAIXA": "avaliacao ilegivel ou fora da faixa 1-5",
}


def with_messages(broken: dict[str, Column], messages: dict[str, str]) -> list[Rule]:
    """Rules in the order of their messages."""
    return [Rule(code, broken[code], message) for code, message in messages.items()]


def content_rules(messages: dict[str, str], repeated: Column) -> list[Rule]:
    return with_messages({
        "ID_INVALIDO": F.col("conteudo_id").isNull(),
        "DUPLICADO": repeated,
        "TIPO_FORA_DO_DOMINIO": outside("tipo", CONTENT_TYPES),
        "CATEGORIA_FORA_DO_DOMINIO": outside("categoria", CATEGORIES),
        "NIVEL_FORA_DO_DOMINIO": outside("nivel", LEVELS),
    }, messages)


def typed_content(raw: DataFrame) -> DataFrame:
    """Catalogue text to typed columns; an unreadable or negative workload becomes null."""
    field = {c: text.blank_to_null(F.col(c)) for c in CATALOG_COLUMNS}
    return raw.withColumns({
        "_id_bruto": F.col("conteudo_id"),
        "conteudo_id": casts.digits_to_long(F.col("conteudo_id")),
        "titulo": field["titulo"],
        "tipo": text.official_label(field["tipo"], CONTENT_TYPES),
        "categoria": text.official_label(field["categoria"], CATEGORIES),
        "nivel": text.official_label(field["nivel"], LEVELS),
        "carga_horaria_min": casts.rounded_not_negative(field["carga_horaria_min"]),
        "data_publicacao": casts.iso_date(field["data_publicacao"]),
        "descricao": field["descricao"],
        "autor": field["autor"],
    })


def judge_content(raw: DataFrame) -> DataFrame:
    marked = mark_repeats(typed_content(raw), ["conteudo_id"], ORDER)
    ordered = content_rules(CONTENT_MESSAGES, F.col("repetida"))
    return rules.apply_rules(marked, ordered).withColumn(
        "registro_id", rules.record_id("catalogo", {"conteudo_id": "_id_bruto"})
    )


def typed_interaction(raw: DataFrame) -> DataFrame:
    """Interaction text to typed columns; the trimmed fields are columns of their own, so that each is trimmed once."""
    trimmed = {c: f"_campo_{c}" for c in INTERACTION_COLUMNS[2:]}
    field = {c: F.col(name) for c, name in trimmed.items()}
    return raw.withColumns({name: text.blank_to_null(F.col(c)) for c, name in trimmed.items()}).withColumns({
        "_usuario_bruto": F.col("usuario_id"),
        "_conteudo_bruto": F.col("conteudo_id"),
        "_data_bruta": field["data_hora"],
        "usuario_id": casts.positive_id(F.col("usuario_id")),
        "conteudo_id": casts.digits_to_long(F.col("conteudo_id")),
        "tipo_interacao": text.official_label(field["tipo_interacao"], INTERACTION_TYPES),
        "data_hora": casts.iso_timestamp(field["data_hora"]),
        "tempo_consumido": casts.rounded_not_negative(field["tempo_consumido"]),
        "percentual_conclusao": casts.rounded_decimal(field["percentual_conclusao"], 2),
        "avaliacao_atribuida": casts.rounded_long(field["avaliacao_atribuida"]),
    }).drop(*trimmed.values())


def with_reference(rows: DataFrame, contents: DataFrame) -> DataFrame:
    """Mark rows whose content exists in Silver."""
    known = contents.select("conteudo_id").withColumn("_existe", F.lit(True))
    return lookup(rows, known, ["conteudo_id"])


def judge_interactions(raw: DataFrame, contents: DataFrame) -> DataFrame:
    marked = mark_repeats(typed_interaction(raw), ["usuario_id", "conteudo_id", "data_hora"], ORDER)
    percent, rating = F.col("percentual_conclusao"), F.col("avaliacao_atribuida")
    ordered = with_messages({
        "USUARIO_INVALIDO": F.col("usuario_id").isNull(),
        "REFERENCIA_INEXISTENTE": F.col("_existe").isNull(),
        "DUPLICADO": F.col("repetida"),
        "TIPO_INTERACAO_FORA_DO_DOMINIO": outside("tipo_interacao", INTERACTION_TYPES),
        "DATA_INVALIDA": F.col("data_hora").isNull(),
        "PERCENTUAL_FORA_DA_FAIXA": percent.isNull() | (percent < 0) | (percent > 100),
        "AVALIACAO_FORA_DA_FAIXA": (rating < 1) | (rating > 5),
    }, INTERACTION_MESSAGES)
    keys = {"usuario_id": "_usuario_bruto", "conteudo_id": "_conteudo_bruto", "data_hora": "_data_bruta"}
    return rules.apply_rules(with_reference(marked, contents), ordered).withColumn(
        "registro_id", rules.record_id("interacoes", keys)
    )


def typed_comment(raw: DataFrame) -> DataFrame:
    field = {c: text.blank_to_null(F.col(c)) for c in COMMENT_COLUMNS}
    return raw.withColumns({
        "_usuario_bruto": F.col("usuario_id"),
        "_conteudo_bruto": F.col("conteudo_id"),
        "_data_bruta": field["data"],
        "_nota_bruta": field["avaliacao"],
        "usuario_id": casts.positive_id(F.col("usuario_id")),
        "conteudo_id": casts.digits_to_long(F.col("conteudo_id")),
        "avaliacao": casts.rounded_long(field["avaliacao"]),
        "comentario": field["comentario"],
        "tags": text.normalize_tags(F.col("tags")),
        "data": casts.iso_date(field["data"]),
    })


def bad_comment_rating() -> Column:
    rating = F.col("avaliacao")
    return F.col("_nota_bruta").isNotNull() & (rating.isNull() | (rating < 1) | (rating > 5))


def judge_comments(raw: DataFrame, contents: DataFrame) -> DataFrame:
    marked = mark_repeats(typed_comment(raw), ["usuario_id", "conteudo_id", "data"], ORDER)
    ordered = with_messages({
        "USUARIO_INVALIDO": F.col("usuario_id").isNull(),
        "REFERENCIA_INEXISTENTE": F.col("_existe").isNull(),
        "DUPLICADO": F.col("repetida"),
        "DATA_INVALIDA": F.col("data").isNull(),
        "AVALIACAO_FORA_DA_FAIXA": bad_comment_rating(),
    }, COMMENT_MESSAGES)
    keys = {"usuario_id": "_usuario_bruto", "conteudo_id": "_conteudo_bruto", "data": "_data_bruta"}
    return rules.apply_rules(with_reference(marked, contents), ordered).withColumn(
        "registro_id", rules.record_id("comentarios", keys)
    )


def under_contract(rows: DataFrame, schema, further: list[str] = []) -> DataFrame:
    """Rows under the Silver schema, audit columns (and ``further`` ones) kept."""
    typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
    return rows.select(*typed, *AUDIT_COLUMNS, *further)


def to_contract(judged: DataFrame, schema) -> DataFrame:
    return under_contract(rules.approved(judged), schema)


RAW_COLUMNS = {"catalogo": CATALOG_COLUMNS, "interacoes": INTERACTION_COLUMNS, "comentarios": COMMENT_COLUMNS}


def to_quarantine(judged: DataFrame, source: str, raw: DataFrame, first_id: int = 0) -> DataFrame:
    """Rejected rows as entries numbered after ``first_id`` in the order of Bronze.

    The raw row is fetched from Bronze by its place, so that no judged row carries its payload along.
    """
    columns = [*RAW_COLUMNS[source], *AUDIT_COLUMNS]
    given = raw.select(ORDER, *[F.col(c).alias(f"_bruto_{c}") for c in columns])
    rejected = rules.rejected(judged).select(ORDER, "registro_id", "regra_violada", "mensagem", "execucao_id")
    payload = rules.raw_payload({c: F.col(f"_bruto_{c}") for c in columns})
    return rejected.join(given.hint("merge"), ORDER).select(
        (F.col(ORDER) + first_id).alias("id"), "registro_id", F.lit(source).alias("origem"), "regra_violada",
        "mensagem", "execucao_id", payload.alias("payload_original"), F.lit("pendente").alias("status"),
    )


def silver_content(raw: DataFrame) -> DataFrame:
    return to_contract(judge_content(raw), SILVER_CONTENT)


def silver_interactions(raw: DataFrame, contents: DataFrame) -> DataFrame:
    return to_contract(judge_interactions(raw, contents), SILVER_INTERACTION)


def silver_comments(raw: DataFrame, contents: DataFrame) -> DataFrame:
    return to_contract(judge_comments(raw, contents), SILVER_COMMENT)
