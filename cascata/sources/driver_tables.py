"""The given parquet tables seen through the data contract of Bronze.

Whole tables are mapped: ``part`` is the catalogue, ``events`` the interactions,
``conversations`` the comments, ``embeddings`` the vectors. Faults are put into some values
(never by leaving rows out) so that every rule has something to catch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cascata.schemas import CATEGORIES
from cascata.functions import text

RUN = "carga-1"
MODEL = "base"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _audit(source: str, file: str) -> dict[str, Column]:
    return {
        "origem": F.lit(source),
        "arquivo_origem": F.lit(file),
        "data_hora_ingestao": F.lit("2024-02-01T00:00:00"),
        "execucao_id": F.lit(RUN),
    }


def _catalog_fields() -> list[Column]:
    labels = F.array(*[F.lit(c) for c in CATEGORIES])
    category = F.element_at(labels, F.expr("cast(p_partkey % 8 as int) + 1"))
    return [
        F.expr("case when p_partkey % 43 = 42 then 'x' else cast(p_partkey as string) end").alias("conteudo_id"),
        F.expr("""case when p_partkey % 53 = 52 then '  ' when p_partkey % 7 = 0 then upper(p_name)
                       when p_partkey % 11 = 0 then replace(p_name, ' ', '  ') else p_name end""").alias("titulo"),
        F.expr("""case when p_partkey % 29 = 28 then 'Workshop' when p_partkey % 4 = 0 then 'Artigo'
                       when p_partkey % 4 = 1 then 'curso ' when p_partkey % 4 = 2 then 'VIDEO'
                       else 'Podcast' end""").alias("tipo"),
        F.when(F.expr("p_partkey % 31 = 30"), F.lit("Culinária"))
        .when(F.expr("p_partkey % 3 = 0"), F.upper(category)).otherwise(category).alias("categoria"),
        F.expr("""case when p_partkey % 37 = 36 then 'Mestre' when p_size % 3 = 0 then 'Básico'
                       when p_size % 3 = 1 then 'intermediario' else 'AVANÇADO' end""").alias("nivel"),
        F.expr("""case when p_partkey % 17 = 0 then 'abc' when p_partkey % 41 = 40 then '-5'
                       when p_partkey % 47 = 46 then concat(cast(p_size as string), '.5')
                       else cast(p_size as string) end""").alias("carga_horaria_min"),
        F.expr("""case when p_partkey % 23 = 22 then null when p_partkey % 61 = 60 then '2024-02-30'
                       else cast(date_add(date'2024-01-01', cast(p_partkey % 365 as int)) as string) end""")
        .alias("data_publicacao"),
        F.col("p_type").alias("descricao"),
        F.expr("case when p_partkey % 71 = 70 then null else concat(p_brand, ' ', p_type) end").alias("autor"),
    ]


def bronze_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part once, and every twentieth a second time as a duplicate."""
    copies = F.sequence(F.lit(0), F.expr("case when p_partkey % 20 = 0 then 1 else 0 end"))
    return table(spark, sf_dir, "part").withColumn("copia", F.explode(copies)).select(
        F.expr("p_partkey * 2 + copia").alias("ordem"),
        *_catalog_fields(),
        *[c.alias(n) for n, c in _audit("catalogo", "catalogo.csv").items()],
    )


# Content an event refers to: the number in its payload, within the shelf of the user's group.
EVENT_CONTENT = "cast(get_json_object(props, '$.k') as bigint) + 100 * (user_id div 15)"


def _interaction_fields() -> list[Column]:
    return [
        F.col("event_id").alias("ordem"),
        F.expr("cast(user_id as string)").alias("usuario_id"),
        F.expr(f"case when event_id % 101 = 100 then 'abc' else cast({EVENT_CONTENT} as string) end").alias("conteudo_id"),
        F.expr("""case event_type when 'view' then 'Visualizacao' when 'click' then 'início'
                       when 'purchase' then 'conclusão' when 'signup' then 'curtida ' else event_type end""")
        .alias("tipo_interacao"),
        F.expr("""case when event_id % 97 = 0 then '2024-02-30'
                       when event_id % 89 = 0 then date_format(ts, 'yyyy-MM-dd 00:00:00')
                       when event_id % 4 = 1 then date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
                       else concat(date_format(ts, 'yyyy-MM-dd'), 'T00:00:00') end""").alias("data_hora"),
        F.expr("""case when event_id % 59 = 0 then null when event_id % 41 = 0
                       then concat('-', cast(cast(floor(value) as bigint) as string))
                       else cast(cast(floor(value) as bigint) as string) end""").alias("tempo_consumido"),
        F.expr("""case when event_id % 10 = 3 then concat(cast(event_id % 106 as string), '.555')
                       else cast(event_id % 106 as string) end""").alias("percentual_conclusao"),
        F.expr("case when event_id % 3 = 0 then cast(event_id % 7 as string) end").alias("avaliacao_atribuida"),
    ]


def bronze_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    audit = [c.alias(n) for n, c in _audit("interacoes", "interacoes.json").items()]
    return table(spark, sf_dir, "events").select(*_interaction_fields(), *audit)


def bronze_interaction_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same interactions as one batch per day of arrival."""
    audit = _audit("interacoes", "interacoes.json") | {
        "data_hora_ingestao": F.expr("date_format(ts, \"yyyy-MM-dd'T'00:00:00\")"),
        "execucao_id": F.expr("concat('carga-', date_format(ts, 'yyyy-MM-dd'))"),
    }
    return table(spark, sf_dir, "events").select(
        *_interaction_fields(), *[c.alias(n) for n, c in audit.items()]
    )


def bronze_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select(
        F.expr("conv_id * 100 + turn").alias("ordem"),
        F.expr("cast(conv_id as string)").alias("usuario_id"),
        F.expr("cast(conv_id * 7 as string)").alias("conteudo_id"),
        F.expr("""case when conv_id % 17 = 16 then 'otimo' else cast(1 + (conv_id + turn) % 6 as string) end""")
        .alias("avaliacao"),
        F.col("text").alias("comentario"),
        F.expr("""case when conv_id % 13 = 0 then 'oops'
                       else concat('["', role, '"," ', upper(role), ' ","tag', cast(turn % 3 as string), '"]') end""")
        .alias("tags"),
        F.expr("""case when (conv_id + turn) % 19 = 0 then 'ontem'
                       else cast(date_add(date'2024-01-01', cast((conv_id + turn div 2) % 30 as int)) as string) end""")
        .alias("data"),
        *[c.alias(n) for n, c in _audit("comentarios", "comentarios.json").items()],
    )


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vector store; some vectors belong to an older model."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("conteudo_id"),
        F.expr(f"case when vec_id % 50 = 49 then 'antigo' else '{MODEL}' end").alias("modelo"),
        F.col("embedding").alias("vetor"),
    )


def stored_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts the stored vectors were made from; some have changed since."""
    fields = table(spark, sf_dir, "part").select("p_partkey", *_catalog_fields())
    texts = fields.select(
        F.col("p_partkey").alias("conteudo_id"),
        text.text_representation(F.col("titulo"), F.col("descricao")).alias("texto"),
    )
    return embeddings(spark, sf_dir).join(texts, "conteudo_id").select(
        "conteudo_id",
        "modelo",
        "vetor",
        F.expr("case when conteudo_id % 10 = 3 then concat('v0 ', texto) else texto end").alias("texto_origem"),
    )


def recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two recommendation batches as a former run would have left them: the five best per user."""
    from cascata.operators.recommend import classify, rank_and_keep

    scored = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("usuario_id"),
        F.expr(f"({EVENT_CONTENT}) + event_id % 2").alias("conteudo_id"),
        F.expr("4100 + (event_id * 37) % 5900").alias("centesimos"),
        F.expr("event_id % 2").alias("lote"),
    )
    best = scored.groupBy("usuario_id", "conteudo_id", "lote").agg(F.max("centesimos").alias("centesimos")).select(
        "usuario_id", "conteudo_id",
        F.expr("timestamp_ntz'2024-02-01 00:00:00' + make_dt_interval(cast(lote as int))").alias("gerado_em"),
        F.expr("cast(centesimos / 100.0 as decimal(5,2))").alias("pontuacao"),
    )
    ranked = rank_and_keep(best, 5, ["gerado_em", "usuario_id"])
    return ranked.withColumn("classificacao", classify(F.col("pontuacao"), F.lit(1)))


def repaired_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all parts, as the Silver catalogue would hold after its faults were corrected."""
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("conteudo_id"))
