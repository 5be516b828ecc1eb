"""Data-quality tests over Silver, their stored results and the publish gate."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from cascata.functions import metrics
from cascata.operators.onerow import side_by_side
from cascata.schemas import QUALITY_RESULT


#: Counts taken while Silver was written.
OBSERVED = "execucao_id string, tabela string, medida string, valor long"


class GateBlocked(RuntimeError):
    """Publication to Gold was refused."""


def check_run_id(run_id: str | None) -> str:
    if run_id is None or not run_id.strip():
        raise ValueError("execucao_id obrigatorio")
    if not re.fullmatch(r"[A-Za-z0-9_.:-]+", run_id):
        raise ValueError(f"execucao_id invalido: {run_id}")
    return run_id


def new_run_id(run_id: str | None = None) -> str:
    """The given id, or a fresh one when it is blank."""
    return check_run_id(run_id) if run_id and run_id.strip() else str(uuid.uuid4())


# The five tests, as published with every result.
BLOCK, NOTE = "bloquear a publicacao na Gold", "registrar ressalva; a Gold continua"
TESTS = {
    "completude_titulo": (
        "silver.conteudo", "completude",
        "100 * conteudos com titulo preenchido / conteudos na silver.conteudo",
        99, ">=", "alta", NOTE, "titulo e atributo essencial do conteudo",
    ),
    "validade_percentual": (
        "silver.interacao", "validade",
        "interacoes com percentual_conclusao fora da faixa 0-100",
        0, "<=", "critica", BLOCK,
        "percentual de conclusao precisa permanecer na faixa do contrato Silver",
    ),
    "unicidade_interacao": (
        "silver.interacao", "unicidade",
        "linhas de silver.interacao menos a chave distinta (usuario_id, conteudo_id, data_hora)",
        0, "<=", "critica", BLOCK, "a chave de negocio da interacao nao pode repetir na Silver",
    ),
    "consistencia_conclusao": (
        "silver.interacao", "consistencia",
        "100 * interacoes do tipo conclusao com percentual >= 100 / interacoes do tipo conclusao",
        90, ">=", "media", NOTE, "uma conclusao deveria corresponder a percentual 100",
    ),
    "integridade_comentario_conteudo": (
        "silver.comentario", "integridade",
        "comentarios cujo conteudo_id nao existe em silver.conteudo",
        0, "<=", "critica", BLOCK, "comentario aprovado precisa apontar para um conteudo mestre",
    ),
}


def title_completeness(contents: DataFrame) -> DataFrame:
    filled = F.count_if(F.trim("titulo") != "")
    share = F.coalesce(metrics.rate_pct(filled, F.count(F.lit(1))), F.lit(0))
    return contents.agg(share.cast("double").alias("completude_titulo"))


def interaction_measures(interactions: DataFrame) -> DataFrame:
    """Validity, uniqueness and consistency in one scan, counted over the business key."""
    percent = F.col("percentual_conclusao")
    concluded = F.col("tipo_interacao") == "conclusão"
    per_key = interactions.groupBy("usuario_id", "conteudo_id", "data_hora").agg(
        F.count(F.lit(1)).alias("_linhas"),
        F.count_if((percent < 0) | (percent > 100)).alias("_fora"),
        F.count_if(concluded).alias("_conclusoes"),
        F.count_if(concluded & (percent >= 100)).alias("_completas"),
    )
    consistency = metrics.rate_pct(F.sum("_completas"), F.sum("_conclusoes"))
    return per_key.agg(
        F.coalesce(F.sum("_fora"), F.lit(0)).cast("double").alias("validade_percentual"),
        F.coalesce(F.sum(F.col("_linhas") - 1), F.lit(0)).cast("double").alias("unicidade_interacao"),
        F.coalesce(consistency, F.lit(100)).cast("double").alias("consistencia_conclusao"),
    )


def comment_integrity(comments: DataFrame, contents: DataFrame) -> DataFrame:
    """Comments without content, counted per content before the anti join."""
    per_content = comments.groupBy("conteudo_id").agg(F.count(F.lit(1)).alias("_n"))
    lost = per_content.join(contents.select("conteudo_id"), "conteudo_id", "left_anti")
    return lost.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("double").alias("integridade_comentario_conteudo"))


def describe_results(measures: DataFrame, run_id: str) -> DataFrame:
    """One result row per measured test; ``measures`` is a single row with a column per test."""
    results = []
    for test in [c for c in measures.columns if c in TESTS]:
        source, dimension, formula, limit, operator, severity, action, message = TESTS[test]
        value = F.col(test)
        passed = value >= limit if operator == ">=" else value <= limit
        results.append(F.struct(
            F.lit(run_id).alias("execucao_id"), F.lit(source).alias("fonte"), F.lit(test).alias("teste"),
            F.lit(dimension).alias("dimensao"), F.lit(formula).alias("formula"), value.alias("valor"),
            F.lit(float(limit)).alias("limite"), F.lit(operator).alias("operador"),
            F.lit(severity).alias("severidade"), passed.alias("aprovado"), F.lit(action).alias("acao"),
            F.lit(message).alias("mensagem"),
        ))
    return measures.select(F.inline(F.array(*results)))


def observations(table: str) -> dict[str, Column]:
    """What the write of a Silver table counts on its way, over approved rows that still carry the marks of the rules."""
    percent, concluded = F.col("percentual_conclusao"), F.col("tipo_interacao") == "conclusão"
    rows = {"linhas": F.count(F.lit(1))}
    return rows | {
        "conteudo": lambda: {"com_titulo": F.count_if(F.trim("titulo") != "")},
        "interacao": lambda: {
            "fora_da_faixa": F.count_if((percent < 0) | (percent > 100)), "repetidas": F.count_if(F.col("repetida")),
            "conclusoes": F.count_if(concluded), "completas": F.count_if(concluded & (percent >= 100)),
        },
        "comentario": lambda: {"sem_conteudo": F.count_if(F.col("_existe").isNull())},
    }[table]()


def observed(rows: DataFrame, table: str) -> tuple[DataFrame, Observation]:
    """Approved rows that are counted while some job writes them."""
    watch = Observation(f"silver_{table}")
    return rows.observe(watch, *[c.alias(name) for name, c in observations(table).items()]), watch


def observed_rows(spark: SparkSession, table: str, watch: Observation, run_id: str) -> DataFrame:
    """What a finished write counted, a row per measure."""
    counted = [
        F.struct(F.lit(run_id).alias("execucao_id"), F.lit(table).alias("tabela"), F.lit(name).alias("medida"), F.lit(int(value or 0)).cast("long").alias("valor"))
        for name, value in watch.get.items()
    ]
    return spark.range(1, numPartitions=1).select(F.inline(F.array(*counted)))


def measures_of(counted: DataFrame) -> DataFrame:
    """One row with the value of each test, from the counts of one run's writes; Silver is not read."""
    def of(table: str, name: str) -> Column:
        picked = (F.col("tabela") == table) & (F.col("medida") == name)
        return F.coalesce(F.sum(F.when(picked, F.col("valor"))), F.lit(0)).alias(f"{table}_{name}")

    names = {t: list(observations(t)) for t in ("conteudo", "interacao", "comentario")}
    row = counted.agg(*[of(t, n) for t in names for n in names[t]])
    return row.select(
        F.coalesce(metrics.rate_pct(F.col("conteudo_com_titulo"), F.col("conteudo_linhas")), F.lit(0)).cast("double").alias("completude_titulo"),
        F.col("interacao_fora_da_faixa").cast("double").alias("validade_percentual"),
        F.col("interacao_repetidas").cast("double").alias("unicidade_interacao"),
        F.coalesce(metrics.rate_pct(F.col("interacao_completas"), F.col("interacao_conclusoes")), F.lit(100)).cast("double").alias("consistencia_conclusao"),
        F.col("comentario_sem_conteudo").cast("double").alias("integridade_comentario_conteudo"),
    )


def run_tests(contents: DataFrame, interactions: DataFrame, comments: DataFrame, run_id: str) -> DataFrame:
    """The five tests over stored tables, whoever wrote them; each table is read once."""
    check_run_id(run_id)
    measures = side_by_side(
        title_completeness(contents), interaction_measures(interactions), comment_integrity(comments, contents)
    )
    return describe_results(measures, run_id)


def replace_run(stored: DataFrame | None, results: DataFrame, run_id: str) -> DataFrame:
    """Stored results with those of this run replaced."""
    if stored is None:
        return results
    return stored.where(F.col("execucao_id") != run_id).unionByName(results)


def verdict(results: DataFrame) -> DataFrame:
    return results.groupBy("execucao_id").agg(
        F.when(F.count_if(~F.col("aprovado")) > 0, "sucesso com ressalvas").otherwise("sucesso").alias("resultado")
    )


def gate(results: DataFrame, run_id: str) -> DataFrame:
    """One row: whether the run may publish, and why not. Five tests bound the list."""
    failed = (F.col("severidade") == "critica") & ~F.col("aprovado")
    summed = results.where(F.col("execucao_id") == run_id).agg(
        F.count(F.lit(1)).alias("testes"),
        F.array_join(F.array_sort(F.collect_set(F.when(failed, F.col("teste")))), ", ").alias("reprovados"),
    )
    reason = (
        F.when(F.col("testes") == 0, f"publicacao gold bloqueada: sem resultado de qualidade para {run_id}")
        .when(
            F.col("reprovados") != "",
            F.concat(
                F.lit("publicacao gold bloqueada: teste critico reprovado ("), F.col("reprovados"),
                F.lit(f") na execucao {run_id}"),
            ),
        )
    )
    return summed.select(
        F.lit(run_id).alias("execucao_id"),
        F.when(reason.isNull(), "liberado").otherwise("bloqueado").alias("situacao"),
        reason.alias("motivo"),
    )


def enforce_gate(results: DataFrame, run_id: str) -> str:
    decision = gate(results, check_run_id(run_id)).first()
    if decision["situacao"] != "liberado":
        raise GateBlocked(decision["motivo"])
    return decision["situacao"]


def history(results: DataFrame) -> DataFrame:
    kept = results.where(F.col("teste").isin("completude_titulo", "consistencia_conclusao"))
    return kept.select("execucao_id", "teste", "fonte", "valor", "limite", "aprovado")
