"""Record validator over raw rows: duplicate, then incomplete, then invalid, else valid."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from cascata.functions import casts
from cascata.operators.skew import lookup, mark_repeats
from cascata.schemas import CATEGORIES, CONTENT_TYPES, INTERACTION_TYPES, LEVELS

VALID, INVALID, INCOMPLETE, DUPLICATE = "validos", "invalidos", "incompletos", "duplicados"
ORDER = "ordem"


def missing_names(columns: list[str], empty_counts: bool) -> Column:
    """Names of the required columns a row lacks."""
    def absent(c: str) -> Column:
        return F.col(c).isNull() | (F.col(c) == "") if empty_counts else F.col(c).isNull()

    return F.array_compact(F.array(*[F.when(absent(c), F.lit(c)) for c in columns]))


def complaint(broken: Column, label: str, value: Column) -> Column:
    return F.when(broken, F.concat(F.lit(f"{label}: "), F.coalesce(value, F.lit("None"))))


def whole_number_complaints(
    number: Column, raw: Column, low: int | None, high: int | None, text_label: str, range_label: str
) -> list[Column]:
    limits = [number < low] if low is not None else []
    limits += [number > high] if high is not None else []
    broken = reduce(lambda a, b: a | b, limits)
    return [
        complaint(raw.isNotNull() & number.isNull(), text_label, raw),
        complaint(broken, range_label, number.cast("string")),
    ]


def classify(
    marked: DataFrame, source: str, record_id: Column, missing: Column, complaints: list[Column], repeat_text: str
) -> DataFrame:
    reasons = F.concat_ws("; ", *complaints)
    judged = marked.withColumns({"_falta": missing, "_motivos": reasons})
    lacking = F.size("_falta") > 0
    listed = F.concat(F.lit("campos ausentes: ['"), F.array_join("_falta", "', '"), F.lit("']"))
    return judged.select(
        ORDER,
        F.lit(source).alias("fonte"),
        record_id.alias("registro_id"),
        F.when(F.col("repetida"), DUPLICATE).when(lacking, INCOMPLETE)
        .when(F.col("_motivos") != "", INVALID).otherwise(VALID).alias("classificacao"),
        F.when(F.col("repetida"), repeat_text).when(lacking, listed)
        .when(F.col("_motivos") != "", F.col("_motivos")).alias("motivo"),
    )


# The messages of the three validators below are fixed values: contract texts, given as they are.


def validate_catalog(raw: DataFrame) -> DataFrame:
    required = ["conteudo_id", "titulo", "tipo", "categoria", "nivel", "carga_horaria_min", "data_publicacao"]
    whole = F.col("carga_horaria_min").rlike(r"^\s*[+-]?\d+\s*$")
    read = raw.withColumn("_carga", F.when(whole, F.trim("carga_horaria_min").try_cast("bigint")))
    marked = mark_repeats(read, ["conteudo_id"], ORDER)
    complaints = [
        complaint(~F.col("tipo").isin(CONTENT_TYPES), "tipo invalido", F.col("tipo")),
        complaint(~F.col("categoria").isin(CATEGORIES), "categoria invalida", F.col("categoria")),
        complaint(~F.col("nivel").isin(LEVELS), "nivel invalido", F.col("nivel")),
        *whole_number_complaints(F.col("_carga"), F.col("carga_horaria_min"), 0, None,
                                 "carga_horaria nao-numerica", "carga_horaria negativa"),
        F.when(
            ~casts.matches_date_format(F.col("data_publicacao")),
            F.concat(F.lit("data_publicacao em formato invalido: "), F.col("data_publicacao"),
                     F.lit(" (esperado YYYY-MM-DD)")),
        ),
    ]
    return classify(marked, "catalogo", F.col("conteudo_id"), missing_names(required, False), complaints,
                    "conteudo_id duplicado")


def pair_id() -> Column:
    return F.concat_ws("-", F.coalesce("usuario_id", F.lit("None")), F.coalesce("conteudo_id", F.lit("None")))


def with_known(rows: DataFrame, ids: DataFrame, key: str, flag: str) -> DataFrame:
    known = ids.select(key).where(F.col(key).isNotNull()).distinct().withColumn(flag, F.lit(True))
    return lookup(rows, known, [key])


def validate_interactions(raw: DataFrame, catalog: DataFrame, users: DataFrame | None = None) -> DataFrame:
    """``users`` are the known ones; without them they are those of this same file, so that none is unknown."""
    read = raw.withColumns({
        "_tempo": casts.truncated_number(F.col("tempo_consumido")),
        "_nota": casts.truncated_number(F.col("avaliacao_atribuida")),
        "_percentual": F.trim("percentual_conclusao").try_cast("double"),
    })
    marked = mark_repeats(read, ["usuario_id", "conteudo_id", "data_hora"], ORDER)
    marked = with_known(marked, catalog, "conteudo_id", "_conteudo")
    marked = marked.withColumn("_usuario", F.lit(True)) if users is None else with_known(marked, users, "usuario_id", "_usuario")
    required = ["usuario_id", "conteudo_id", "tipo_interacao", "data_hora", "tempo_consumido", "percentual_conclusao"]
    percent = F.col("_percentual")
    complaints = [
        complaint(~F.col("tipo_interacao").isin(INTERACTION_TYPES), "tipo_interacao invalido", F.col("tipo_interacao")),
        complaint(F.col("_usuario").isNull(), "usuario_id inexistente", F.col("usuario_id")),
        complaint(F.col("_conteudo").isNull(), "conteudo_id inexistente", F.col("conteudo_id")),
        *whole_number_complaints(F.col("_tempo"), F.col("tempo_consumido"), 0, None,
                                 "tempo_consumido nao-numerico", "tempo_consumido negativo"),
        complaint((percent < 0) | (percent > 100), "percentual fora de 0-100", percent.cast("string")),
        complaint(percent.isNull(), "percentual nao-numerico", F.col("percentual_conclusao")),
        *whole_number_complaints(F.col("_nota"), F.col("avaliacao_atribuida"), 1, 5,
                                 "avaliacao nao-numerica", "avaliacao fora de 1-5"),
        F.when(
            ~casts.matches_timestamp_format(F.col("data_hora")),
            F.concat(F.lit("data_hora em formato invalido: "), F.col("data_hora"),
                     F.lit(" (esperado YYYY-MM-DDTHH:MM:SS)")),
        ),
    ]
    return classify(marked, "interacoes", pair_id(), missing_names(required, False), complaints, "interacao duplicada")


def validate_comments(raw: DataFrame, catalog: DataFrame, interactions: DataFrame) -> DataFrame:
    read = raw.withColumns({
        "_nota": casts.truncated_number(F.col("avaliacao")),
        "_lista": F.from_json("tags", "array<string>").isNotNull(),
    })
    marked = mark_repeats(read, ["usuario_id", "conteudo_id", "data"], ORDER)
    marked = with_known(marked, interactions, "usuario_id", "_usuario")
    marked = with_known(marked, catalog, "conteudo_id", "_conteudo")
    required = ["usuario_id", "conteudo_id", "avaliacao", "comentario", "data"]
    not_a_list = F.col("tags").isNotNull() & ~F.col("_lista")
    complaints = [
        *whole_number_complaints(F.col("_nota"), F.col("avaliacao"), 1, 5,
                                 "avaliacao nao-numerica", "avaliacao fora de 1-5"),
        complaint(F.col("_usuario").isNull(), "usuario_id inexistente", F.col("usuario_id")),
        complaint(F.col("_conteudo").isNull(), "conteudo_id inexistente", F.col("conteudo_id")),
        F.when(not_a_list, F.lit("tags nao e lista")),
        F.when(
            ~casts.matches_date_format(F.col("data")),
            F.concat(F.lit("data em formato invalido: "), F.col("data"), F.lit(" (esperado YYYY-MM-DD)")),
        ),
    ]
    return classify(marked, "comentarios", pair_id(), missing_names(required, True), complaints, "comentario duplicado")


def report_counts(*judged: DataFrame) -> DataFrame:
    together = reduce(DataFrame.unionByName, judged)
    return together.groupBy("fonte", "classificacao").agg(F.count(F.lit(1)).alias("total"))


def report_reasons(*judged: DataFrame) -> DataFrame:
    together = reduce(DataFrame.unionByName, judged)
    return together.where(F.col("classificacao") != VALID).select("fonte", "registro_id", "classificacao", "motivo")
