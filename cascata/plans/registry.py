"""Every query by name: the Spark job and, beside it, the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from cascata.functions import casts, text
from cascata.functions.vectors import scaled_to_unit
from cascata.operators import (
    audit, clean, column_lineage, governance, gold, kpi, load, lookups, master_data, master_data_runs, merge, privacy, quality, quarantine,
    recommend, search, silver, validate, vector_index,
)
from cascata.plans.layers import BATCH, DIMENSION, MODEL, RUN, Layers, layers
from cascata.plans.oracle import DAY, INSTANT, pct, ratio, with_ctes
from cascata.schemas import AUDIT_COLUMNS, CATALOG_COLUMNS, COMMENT_COLUMNS, INTERACTION_COLUMNS
from cascata.session import materialize, new_folder
from cascata.sources import driver_tables as given, files, keyed, writers
from cascata.streaming import engagement_stream

USER, CONTENT = 13, 92
QUERY_VECTORS = (100, 200, 300)
SALT = "sal-de-exemplo-0001"


@dataclass(frozen=True)
class Query:
    run: Callable[[Layers], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}
BODIES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(run: Callable[[Layers], DataFrame]):
        QUERIES[name] = Query(run, with_ctes(sql) if sql else None)
        BODIES[name] = sql or ""
        return run

    return add


def comparable(rows: DataFrame) -> DataFrame:
    """Column types both engines print alike: whole numbers, doubles, booleans and text."""
    def plain(field: T.StructField) -> Column:
        c, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(kind, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(kind, T.ArrayType):
            if isinstance(kind.elementType, (T.FloatType, T.DoubleType)):  # in millionths
                c = F.transform(c, lambda x: F.round(x.cast("double") * 1_000_000).cast("bigint"))
            c = F.array_join(c, ",")
        return c.alias(field.name)

    return rows.select(*[plain(f) for f in rows.schema.fields])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(q: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: comparable(q.run(layers(spark, sf_dir)))

    return {name: bind(q) for name, q in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: q.sql for name, q in QUERIES.items() if q.sql}


def cols(names: list[str], prefix: str = "") -> str:
    return ", ".join(prefix + n for n in names)


S_CONTENT = f"conteudo_id, titulo, tipo, categoria, nivel, carga_horaria_min, strftime(data_publicacao, {DAY}) AS data_publicacao, descricao, autor"
S_INTERACTION = (
    f"usuario_id, conteudo_id, tipo_interacao, strftime(data_hora, {INSTANT}) AS data_hora, tempo_consumido, "
    "CAST(percentual_conclusao AS DOUBLE) AS percentual_conclusao, avaliacao_atribuida"
)
S_COMMENT = f"usuario_id, conteudo_id, avaliacao, comentario, array_to_string(tags, ',') AS tags, strftime(data, {DAY}) AS data"
TEXT_AUDIT = "origem, data_hora_ingestao, execucao_id"


# ------------------------------------------------------------------ sources

def catalog_file(L: Layers) -> str:
    path = new_folder(L.spark, "catalogo_csv")
    writers.write_csv(L.catalog.select(*CATALOG_COLUMNS), path)
    return path


def interactions_file(L: Layers) -> str:
    path = new_folder(L.spark, "interacoes_json")
    writers.write_json_arrays(L.raw_interactions.select(*INTERACTION_COLUMNS), path)
    return path


def as_given(contents):
    """Contents with the day of publication as text, as the SQL has it."""
    return contents.withColumn("data_publicacao", F.date_format("data_publicacao", "yyyy-MM-dd"))


def comments_file(L: Layers) -> str:
    path = new_folder(L.spark, "comentarios_json")
    tags = F.from_json("tags", "array<string>").alias("tags")
    writers.write_json_arrays(L.raw_comments.select(*[tags if c == "tags" else c for c in COMMENT_COLUMNS]), path)
    return path


@query("scan_catalog_csv", f"SELECT conteudo_id, titulo, tipo, categoria, nivel, CAST(carga_horaria_min AS VARCHAR) AS carga_horaria_min, "
       f"strftime(data_publicacao, {DAY}) AS data_publicacao, descricao, autor FROM silver_conteudo")
def _(L):
    path = new_folder(L.spark, "catalogo_tipado")
    writers.write_csv(L.contents.select(*CATALOG_COLUMNS), path)
    return files.scan_catalog_csv(L.spark, path)


@query("scan_interactions_json", "SELECT usuario_id, conteudo_id, tipo_interacao, strftime(data_hora, '%Y-%m-%dT%H:%M:%S') AS data_hora, "
       "CAST(tempo_consumido AS DOUBLE) AS tempo_consumido, CAST(percentual_conclusao AS DOUBLE) AS percentual_conclusao, "
       "CAST(avaliacao_atribuida AS DOUBLE) AS avaliacao_atribuida FROM silver_interacao")
def _(L):
    path = new_folder(L.spark, "interacoes_tipadas")
    stamped = L.interactions.withColumn("data_hora", F.date_format("data_hora", "yyyy-MM-dd'T'HH:mm:ss"))
    writers.write_json_arrays(stamped.select(*INTERACTION_COLUMNS), path)
    return files.scan_interactions_json(L.spark, path)


@query("scan_comments_json", f"SELECT {S_COMMENT} FROM silver_comentario")
def _(L):
    path = new_folder(L.spark, "comentarios_tipados")
    writers.write_json_arrays(L.comments.select(*COMMENT_COLUMNS), path)
    return files.scan_comments_json(L.spark, path)


@query("bronze_catalog", f"SELECT {cols(CATALOG_COLUMNS)}, {TEXT_AUDIT}, true AS com_arquivo FROM bronze_catalogo")
def _(L):
    rows = files.bronze_catalog(L.spark, catalog_file(L), RUN, "2024-02-01T00:00:00")
    return rows.select(*CATALOG_COLUMNS, "origem", "data_hora_ingestao", "execucao_id",
                       F.endswith("arquivo_origem", F.lit(".csv")).alias("com_arquivo"))


@query("bronze_interactions", f"SELECT {cols(INTERACTION_COLUMNS)}, {TEXT_AUDIT} FROM bronze_interacoes")
def _(L):
    rows = files.bronze_interactions(L.spark, interactions_file(L), RUN, "2024-02-01T00:00:00")
    return rows.select(*INTERACTION_COLUMNS, "origem", "data_hora_ingestao", "execucao_id")


@query("bronze_comments", "SELECT usuario_id, conteudo_id, avaliacao, comentario, CASE WHEN json_valid(tags) THEN tags END AS tags, data, "
       f"{TEXT_AUDIT} FROM bronze_comentarios")
def _(L):
    rows = files.bronze_comments(L.spark, comments_file(L), RUN, "2024-02-01T00:00:00")
    return rows.select(*COMMENT_COLUMNS, "origem", "data_hora_ingestao", "execucao_id")


@query("audit_columns", " UNION ALL ".join(
    f"SELECT origem, execucao_id, count(*) AS linhas, 1 AS instantes, count(*) AS com_arquivo FROM bronze_{t} GROUP BY ALL"
    for t in ("catalogo", "interacoes", "comentarios")))
def _(L):
    audited = ["origem", "execucao_id", "data_hora_ingestao", "arquivo_origem"]
    rows = files.bronze_interactions(L.spark, interactions_file(L), RUN).select(audited).unionByName(
        files.bronze_catalog(L.spark, catalog_file(L), RUN).select(audited)).unionByName(
        files.bronze_comments(L.spark, comments_file(L), RUN).select(audited))
    return rows.groupBy("origem", "execucao_id").agg(
        F.count(F.lit(1)).alias("linhas"), F.count_distinct("data_hora_ingestao").alias("instantes"),
        F.count("arquivo_origem").alias("com_arquivo"),
    )


@query("scan_latest_batch", "SELECT e.event_id AS ordem, b.usuario_id, b.conteudo_id, 'carga-' || strftime(e.ts, '%Y-%m-%d') AS execucao_id "
       "FROM bronze_interacoes b JOIN events e ON e.event_id = b.ordem WHERE CAST(e.ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)")
def _(L):
    batches = given.bronze_interaction_batches(L.spark, L.sf_dir)
    return files.latest_batch(batches).select("ordem", "usuario_id", "conteudo_id", "execucao_id")


@query("scan_corrupt_file", """SELECT 'comentarios' AS origem, 'ARQUIVO_CORROMPIDO' AS regra_violada, 'Expecting '','' delimiter' AS mensagem, 2 AS linha,
    '{}' AS payload_original, 'pendente' AS status, 'lote=' || (turn % 5) AS arquivo FROM conversations GROUP BY ALL HAVING count(*) > 1""")
def _(L):
    """Files of comments none of which is JSON: what the parser says of each."""
    path = new_folder(L.spark, "comentarios_quebrados")
    record = F.to_json(F.struct(*COMMENT_COLUMNS))
    broken = L.raw_comments.select(F.concat(F.lit("[{\"resto\": "), record).alias("value"), (F.col("ordem") % 100 % 5).alias("lote"))
    broken = broken.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("lote"))).where("_n > 1").drop("_n")
    broken.repartition("lote").write.partitionBy("lote").text(path)
    entries = quarantine.corrupt_file_entries(files.corrupt_files(L.spark, path, "comentarios", COMMENT_COLUMNS), RUN)
    return entries.select(
        "origem", "regra_violada", F.split("mensagem", ": ")[0].alias("mensagem"), F.regexp_extract("mensagem", "line (\\d+)", 1).cast("bigint").alias("linha"),
        "payload_original", "status", F.regexp_extract("registro_id", "(lote=\\d+)/", 1).alias("arquivo"))


@query("scan_table", "SELECT usuario_id, conteudo_id, tipo_interacao, tempo_consumido FROM silver_interacao")
def _(L):
    path = new_folder(L.spark, "tabela")
    L.interactions.write.parquet(path)
    return files.scan_table(L.spark, path, ["usuario_id", "conteudo_id", "tipo_interacao", "tempo_consumido"])


def month_folder(L: Layers) -> DataFrame:
    path = new_folder(L.spark, "interacao_mes")
    writers.write_month_partitions(L.interactions, path)
    return writers.read_month_partitions(L.spark, path, L.interactions.schema)


@query("sink_parquet_ym", f"SELECT {S_INTERACTION}, strftime(data_hora, '%Y') AS ano, strftime(data_hora, '%m') AS mes, execucao_id FROM silver_interacao")
def _(L):
    return month_folder(L).select(*INTERACTION_COLUMNS, "ano", "mes", "execucao_id")


@query("scan_parquet_partitioned", f"SELECT {S_INTERACTION}, strftime(data_hora, '%Y') AS ano, strftime(data_hora, '%m') AS mes FROM silver_interacao")
def _(L):
    return month_folder(L).select(*INTERACTION_COLUMNS, "ano", "mes")


@query("scan_month_pruned", "SELECT strftime(data_hora, '%Y-%m-%d') AS data, count(*) AS linhas FROM silver_interacao "
       "WHERE month(data_hora) = 1 GROUP BY ALL")
def _(L):
    january = writers.month_slice(month_folder(L), "01")
    return january.groupBy(F.to_date("data_hora").alias("data")).agg(F.count(F.lit(1)).alias("linhas"))


# -------------------------------------------------------------------- sinks

CLEAN_CATALOG = (f"ordem, conteudo_id, titulo, tipo, categoria, nivel, carga AS carga_horaria_min, "
                 f"strftime(data_publicacao, {DAY}) AS data_publicacao, descricao, autor")
CLEAN_INTERACTION = ("ordem, usuario_id, conteudo_id, tipo_interacao, data_hora, tempo_consumido, "
                     "CAST(percentual_conclusao AS DOUBLE) AS percentual_conclusao, avaliacao_atribuida")


@query("sink_csv", f"SELECT {CLEAN_CATALOG} FROM limpo_catalogo WHERE vez = 1")
def _(L):
    path = new_folder(L.spark, "catalogo_tratado")
    cleaned = clean.clean_catalog(L.catalog)
    writers.write_csv(cleaned, path)
    return L.spark.read.schema(cleaned.schema).options(header=True, multiLine=True, escape='"').csv(path)


@query("sink_json", f"SELECT {CLEAN_INTERACTION} FROM limpo_interacoes WHERE vez = 1")
def _(L):
    path = new_folder(L.spark, "interacoes_tratadas")
    cleaned = clean.clean_interactions(L.raw_interactions)
    writers.write_json(cleaned, path)
    return L.spark.read.schema(cleaned.schema).json(path)


@query("sink_silver_file", f"SELECT {S_INTERACTION}, execucao_id FROM silver_interacao")
def _(L):
    path = new_folder(L.spark, "silver_carga")
    for _attempt in range(2):
        writers.append_run(L.interactions, path)
    return L.spark.read.parquet(path).select(*INTERACTION_COLUMNS, "execucao_id")


@query("sink_quarantine_file", "SELECT id, registro_id, origem, regra_violada, payload_original, 'pendente' AS status FROM rejeitados")
def _(L):
    """The entries as ``append_run`` stored them under their run, read back."""
    return L.quarantine.select("id", "registro_id", "origem", "regra_violada", "payload_original", "status")


@query("sink_parquet_fixed_schema", f"SELECT conteudo_id, strftime(data, {DAY}) AS data, total_interacoes, visualizacoes, inicios, conclusoes, "
       "curtidas, avaliacoes, soma_avaliacao, tempo_total_min, 'carga-1' AS execucao_id, 'spark' AS runner FROM fato")
def _(L):
    path = new_folder(L.spark, "fato")
    writers.write_fact_file(L.fact, path, "spark")
    return L.spark.read.parquet(path)


@query("sink_upsert_users", "SELECT DISTINCT usuario_id FROM (SELECT usuario_id FROM silver_interacao UNION ALL SELECT usuario_id FROM silver_comentario)")
def _(L):
    base = new_folder(L.spark, "usuarios")
    keyed.create(L.comments.select("usuario_id").distinct(), base, "usuario", ["usuario_id"], "v1")
    keyed.insert_absent(L.spark, base, "usuario", L.interactions.select("usuario_id").distinct(), "v2")
    return keyed.read(L.spark, base, "usuario")


@query("sink_upsert_contents", f"SELECT {S_CONTENT} FROM (SELECT * REPLACE (CASE WHEN data_publicacao >= DATE '2024-07-01' THEN upper(titulo) "
       "ELSE titulo END AS titulo) FROM silver_conteudo)")
def _(L):
    """A keyed table of the contents after an upsert of those published late, whose titles change."""
    base, stored = new_folder(L.spark, "conteudos"), L.contents.select(*CATALOG_COLUMNS)
    keyed.create(stored, base, "conteudo", ["conteudo_id"], "v1")
    updates = stored.where("data_publicacao >= date'2024-07-01'").withColumn("titulo", F.upper("titulo"))
    keyed.upsert(L.spark, base, "conteudo", updates, "v2")
    return as_given(keyed.read(L.spark, base, "conteudo"))


UPSERTED = """SELECT {columns} FROM (
    SELECT *, row_number() OVER (PARTITION BY usuario_id, conteudo_id, {key} ORDER BY ordem DESC) AS escolha FROM {table} WHERE {ok}) WHERE escolha = 1"""


@query("sink_upsert_interactions", UPSERTED.format(
    key="data_hora", columns=S_INTERACTION, table="julgado_interacao", ok="regra_violada IS NULL OR regra_violada = 'DUPLICADO'"))
def _(L):
    """Whole rows: the first of each key, then the last of every repeated key over it; a key whose first row was rejected enters with its last."""
    keys = ["usuario_id", "conteudo_id", "data_hora"]
    judged = silver.judge_interactions(L.raw_interactions, L.contents)
    repeated = judged.where("regra_violada = 'DUPLICADO'").select("ordem", *INTERACTION_COLUMNS)
    base = new_folder(L.spark, "interacoes")
    keyed.create(judged.where("regra_violada is null").select(*INTERACTION_COLUMNS), base, "interacao", keys, "v1")
    keyed.upsert(L.spark, base, "interacao", merge.last_per_key(materialize(repeated, "repetidas"), keys, "ordem").drop("ordem"), "v2")
    return keyed.read(L.spark, base, "interacao")


COMMENT_KEYS = ["usuario_id", "conteudo_id", "data"]


def stored_comments(L: Layers) -> tuple[str, DataFrame]:
    """A keyed table of the first comment of each key, and all comments."""
    typed = silver.typed_comment(L.raw_comments).where("usuario_id is not null and data is not null")
    rows, base = materialize(typed.select("ordem", *COMMENT_COLUMNS), "comentarios"), new_folder(L.spark, "comentarios")
    firsts = silver.mark_repeats(rows, COMMENT_KEYS, "ordem").where("not repetida").select(*COMMENT_COLUMNS)
    keyed.create(firsts, base, "comentario", COMMENT_KEYS, "v1")
    return base, rows


@query("sink_upsert_comments", UPSERTED.format(
    key="data", columns=S_COMMENT, table="tipado_comentario", ok="usuario_id IS NOT NULL AND data IS NOT NULL"))
def _(L):
    base, rows = stored_comments(L)
    keyed.upsert(L.spark, base, "comentario", merge.last_per_key(rows, COMMENT_KEYS, "ordem").drop("ordem"), "v2")
    return keyed.read(L.spark, base, "comentario")


@query("sink_insert_absent_comments", UPSERTED.replace("ordem DESC", "ordem").format(
    key="data", columns=S_COMMENT, table="tipado_comentario", ok="usuario_id IS NOT NULL AND data IS NOT NULL"))
def _(L):
    base, rows = stored_comments(L)
    keyed.insert_absent(L.spark, base, "comentario", merge.last_per_key(rows, COMMENT_KEYS, "ordem").drop("ordem"), "v2")
    return keyed.read(L.spark, base, "comentario")


@query("sink_upsert_embeddings", """SELECT coalesce(d.conteudo_id, g.conteudo_id) AS conteudo_id,
    CASE WHEN d.conteudo_id IS NOT NULL THEN 'base' ELSE g.modelo END AS modelo,
    coalesce(d.texto_origem, g.texto_origem) AS texto_origem, coalesce(d.vetor, g.vetor) AS vetor
    FROM guardados g FULL JOIN codificados d ON d.conteudo_id = g.conteudo_id""")
def _(L):
    base, stored = new_folder(L.spark, "vetores"), L.stored_texts
    keyed.create(stored, base, "embedding_conteudo", ["conteudo_id"], "v1")
    delta = search.embedding_delta(L.contents, stored, MODEL)
    keyed.upsert(L.spark, base, "embedding_conteudo", search.embed_pending(delta, search.hashing_encoder(DIMENSION), MODEL), "v2")
    return keyed.read(L.spark, base, "embedding_conteudo")


@query("sink_recommendation_batch", f"SELECT usuario_id, conteudo_id, strftime(gerado_em, {INSTANT}) AS gerado_em, CAST(pontuacao AS DOUBLE) AS pontuacao, "
       "posicao, classificacao FROM recomendacao")
def _(L):
    """Both batches, the last of them written twice."""
    path = new_folder(L.spark, "lotes")
    writers.append_recommendations(L.recommendations, path)
    writers.append_recommendations(recommend.batch_rows(gold.last_batch(L.recommendations)), path)
    return L.spark.read.parquet(path).select("usuario_id", "conteudo_id", "gerado_em", "pontuacao", "posicao", "classificacao")


@query("sink_gold_replace", """SELECT 'carga-2' AS versao, 'dim_conteudo' AS tabela, count(*) AS linhas FROM silver_conteudo
    UNION ALL SELECT 'carga-2', 'fato_engajamento_dia', count(*) FROM fato
    UNION ALL SELECT 'carga-2', 'kpi_desempenho_categoria', count(*) FROM por_categoria
    UNION ALL SELECT 'carga-2', 'kpi_engajamento_formato', count(*) FROM por_formato
    UNION ALL SELECT 'carga-2', 'kpi_evolucao_dia', count(*) FROM por_dia
    UNION ALL SELECT 'carga-2', 'kpi_conversao_recomendacao', count(*) FROM conversao
    UNION ALL SELECT 'carga-2', 'kpi_geral', count(*) FROM geral""")
def _(L):
    """Two runs publish all seven tables, each as one commit; what is read is the second."""
    base = new_folder(L.spark, "gold")
    for run_id in ("carga-1", "carga-2"):
        tables = {name: rows.withColumn("execucao_id", F.lit(run_id)) for name, rows in L.gold.items()}
        version = writers.publish_version(tables, base, run_id)
    counted = [
        writers.read_current(L.spark, base, name, version).groupBy(F.col("execucao_id").alias("versao"))
        .agg(F.count(F.lit(1)).alias("linhas")).select("versao", F.lit(name).alias("tabela"), "linhas")
        for name in version.tables
    ]
    return reduce(DataFrame.unionByName, counted)


# ------------------------------------------------------- validation, cleaning

def complaint_sql(parts: list[str]) -> str:
    return f"concat_ws('; ', {', '.join(parts)})"


def missing_sql(names: list[str], empty: bool = False) -> str:
    items = ", ".join(f"CASE WHEN {n} IS NULL{f' OR {n} = ' + chr(39) * 2 if empty else ''} THEN '{n}' END" for n in names)
    return f"list_filter([{items}], lambda x: x IS NOT NULL)"


def validated_sql(source: str, ident: str, table: str, missing: str, reasons: str, repeat: str) -> str:
    return f"""SELECT ordem, '{source}' AS fonte, {ident} AS registro_id,
        CASE WHEN vez > 1 THEN 'duplicados' WHEN len(falta) > 0 THEN 'incompletos' WHEN motivos <> '' THEN 'invalidos' ELSE 'validos' END AS classificacao,
        CASE WHEN vez > 1 THEN '{repeat}' WHEN len(falta) > 0 THEN 'campos ausentes: [''' || array_to_string(falta, ''', ''') || ''']'
             WHEN motivos <> '' THEN motivos END AS motivo
        FROM (SELECT *, {missing} AS falta, {reasons} AS motivos FROM {table})"""


PAIR = "coalesce(usuario_id, 'None') || '-' || coalesce(conteudo_id, 'None')"
TYPE_LIST = "('Artigo', 'Curso', 'Podcast', 'Vídeo')"
CAT_LIST = ("('Banco de Dados', 'Business Intelligence', 'Ciência de Dados', 'DevOps & Cloud', 'Engenharia de Dados', "
            "'Inteligência Artificial', 'Programação & Software', 'Segurança & Governança')")
KIND_LIST = "('avaliação', 'compartilhamento', 'conclusão', 'curtida', 'início', 'visualização')"
V_CATALOG = validated_sql(
    "catalogo", "conteudo_id", "(SELECT *, row_number() OVER (PARTITION BY conteudo_id ORDER BY ordem) AS vez FROM bronze_catalogo)",
    missing_sql(["conteudo_id", "titulo", "tipo", "categoria", "nivel", "carga_horaria_min", "data_publicacao"]),
    complaint_sql([
        f"CASE WHEN tipo NOT IN {TYPE_LIST} THEN 'tipo invalido: ' || tipo END",
        f"CASE WHEN categoria NOT IN {CAT_LIST} THEN 'categoria invalida: ' || categoria END",
        "CASE WHEN nivel NOT IN ('Básico', 'Intermediário', 'Avançado') THEN 'nivel invalido: ' || nivel END",
        "CASE WHEN NOT regexp_matches(carga_horaria_min, '^[+-]?\\d+$') THEN 'carga_horaria nao-numerica: ' || carga_horaria_min "
        "WHEN CAST(carga_horaria_min AS BIGINT) < 0 THEN 'carga_horaria negativa: ' || carga_horaria_min END",
        "CASE WHEN TRY_CAST(data_publicacao AS DATE) IS NULL THEN 'data_publicacao em formato invalido: ' || data_publicacao || ' (esperado YYYY-MM-DD)' END",
    ]), "conteudo_id duplicado")
V_INTERACTION = validated_sql(
    "interacoes", PAIR, "(SELECT b.*, k.conteudo_id IS NOT NULL AS existe, row_number() OVER (PARTITION BY b.usuario_id, b.conteudo_id, b.data_hora ORDER BY b.ordem) AS vez "
    "FROM bronze_interacoes b LEFT JOIN (SELECT DISTINCT conteudo_id FROM bronze_catalogo) k ON k.conteudo_id = b.conteudo_id)",
    missing_sql(["usuario_id", "conteudo_id", "tipo_interacao", "data_hora", "tempo_consumido", "percentual_conclusao"]),
    complaint_sql([
        f"CASE WHEN tipo_interacao NOT IN {KIND_LIST} THEN 'tipo_interacao invalido: ' || tipo_interacao END",
        "CASE WHEN NOT existe THEN 'conteudo_id inexistente: ' || conteudo_id END",
        "CASE WHEN CAST(tempo_consumido AS BIGINT) < 0 THEN 'tempo_consumido negativo: ' || CAST(CAST(tempo_consumido AS BIGINT) AS VARCHAR) END",
        "CASE WHEN CAST(percentual_conclusao AS DOUBLE) > 100 THEN 'percentual fora de 0-100: ' || CAST(CAST(percentual_conclusao AS DOUBLE) AS VARCHAR) END",
        "CASE WHEN CAST(avaliacao_atribuida AS BIGINT) NOT BETWEEN 1 AND 5 THEN 'avaliacao fora de 1-5: ' || avaliacao_atribuida END",
        "CASE WHEN TRY_CAST(data_hora AS TIMESTAMP) IS NULL OR data_hora NOT LIKE '%T%' THEN 'data_hora em formato invalido: ' || data_hora || ' (esperado YYYY-MM-DDTHH:MM:SS)' END",
    ]), "interacao duplicada")
V_COMMENT = validated_sql(
    "comentarios", PAIR, "(SELECT b.*, k.conteudo_id IS NOT NULL AS existe, u.usuario_id IS NOT NULL AS usuario, "
    "row_number() OVER (PARTITION BY b.usuario_id, b.conteudo_id, b.data ORDER BY b.ordem) AS vez "
    "FROM bronze_comentarios b LEFT JOIN (SELECT DISTINCT conteudo_id FROM bronze_catalogo) k ON k.conteudo_id = b.conteudo_id "
    "LEFT JOIN (SELECT DISTINCT usuario_id FROM bronze_interacoes) u ON u.usuario_id = b.usuario_id)",
    missing_sql(["usuario_id", "conteudo_id", "avaliacao", "comentario", "data"], True),
    complaint_sql([
        "CASE WHEN TRY_CAST(avaliacao AS BIGINT) IS NULL THEN 'avaliacao nao-numerica: ' || avaliacao "
        "WHEN CAST(avaliacao AS BIGINT) NOT BETWEEN 1 AND 5 THEN 'avaliacao fora de 1-5: ' || avaliacao END",
        "CASE WHEN NOT usuario THEN 'usuario_id inexistente: ' || usuario_id END",
        "CASE WHEN NOT existe THEN 'conteudo_id inexistente: ' || conteudo_id END",
        "CASE WHEN NOT json_valid(tags) THEN 'tags nao e lista' END",
        "CASE WHEN TRY_CAST(data AS DATE) IS NULL THEN 'data em formato invalido: ' || data || ' (esperado YYYY-MM-DD)' END",
    ]), "comentario duplicado")


def validated(L: Layers) -> tuple[DataFrame, DataFrame, DataFrame]:
    return (
        validate.validate_catalog(L.catalog),
        validate.validate_interactions(L.raw_interactions, L.catalog),
        validate.validate_comments(L.raw_comments, L.catalog, L.raw_interactions),
    )


query("validate_catalog", V_CATALOG)(lambda L: validate.validate_catalog(L.catalog))
query("validate_interactions", V_INTERACTION)(lambda L: validate.validate_interactions(L.raw_interactions, L.catalog))
query("validate_comments", V_COMMENT)(lambda L: validate.validate_comments(L.raw_comments, L.catalog, L.raw_interactions))
query("validate_interactions_known", V_INTERACTION.replace(
    "LEFT JOIN (SELECT DISTINCT conteudo_id FROM bronze_catalogo) k ON k.conteudo_id = b.conteudo_id)",
    "LEFT JOIN (SELECT DISTINCT conteudo_id FROM bronze_catalogo) k ON k.conteudo_id = b.conteudo_id "
    "LEFT JOIN (SELECT DISTINCT usuario_id AS conhecido FROM bronze_comentarios) u ON u.conhecido = b.usuario_id)").replace("k.conteudo_id IS NOT NULL AS existe", "k.conteudo_id IS NOT NULL AS existe, u.conhecido").replace(
    "CASE WHEN NOT existe THEN 'conteudo_id", "CASE WHEN conhecido IS NULL THEN 'usuario_id inexistente: ' || usuario_id END, CASE WHEN NOT existe THEN 'conteudo_id"))(
    lambda L: validate.validate_interactions(L.raw_interactions, L.catalog, L.raw_comments))
V_ALL = f"SELECT * FROM ({V_CATALOG}) UNION ALL SELECT * FROM ({V_INTERACTION}) UNION ALL SELECT * FROM ({V_COMMENT})"
query("validation_report", f"SELECT fonte, classificacao, count(*) AS total FROM ({V_ALL}) GROUP BY ALL")(
    lambda L: validate.report_counts(*validated(L)))
query("validation_reasons", f"SELECT fonte, registro_id, classificacao, motivo FROM ({V_ALL}) WHERE classificacao <> 'validos'")(
    lambda L: validate.report_reasons(*validated(L)))


@query("strict_date_format", """SELECT 'interacoes' AS fonte, ordem, coalesce(TRY_CAST(data_hora AS TIMESTAMP) IS NOT NULL AND data_hora LIKE '%T%', false) AS valida
    FROM bronze_interacoes UNION ALL SELECT 'catalogo', ordem, coalesce(TRY_CAST(data_publicacao AS DATE) IS NOT NULL, false) FROM bronze_catalogo
    UNION ALL SELECT 'comentarios', ordem, coalesce(TRY_CAST(data AS DATE) IS NOT NULL, false) FROM bronze_comentarios""")
def _(L):
    times = L.raw_interactions.select(F.lit("interacoes").alias("fonte"), "ordem",
                                      casts.matches_timestamp_format(F.col("data_hora")).alias("valida"))
    days = [(L.catalog, "catalogo", "data_publicacao"), (L.raw_comments, "comentarios", "data")]
    for rows, source, column in days:
        times = times.unionByName(rows.select(F.lit(source).alias("fonte"), "ordem", casts.matches_date_format(F.col(column)).alias("valida")))
    return times


query("clean_catalog", f"SELECT {CLEAN_CATALOG} FROM limpo_catalogo WHERE vez = 1")(lambda L: clean.clean_catalog(L.catalog))
query("clean_interactions", f"SELECT {CLEAN_INTERACTION} FROM limpo_interacoes WHERE vez = 1")(
    lambda L: clean.clean_interactions(L.raw_interactions))
query("clean_comments", f"SELECT ordem, {S_COMMENT} FROM limpo_comentarios WHERE vez = 1")(
    lambda L: clean.clean_comments(L.raw_comments))


@query("clean_text", "SELECT ordem, NULLIF(trim(titulo), '') AS titulo, trim(tipo) AS tipo FROM bronze_catalogo")
def _(L):
    return L.catalog.select("ordem", *[text.clean_text(F.col(c)).alias(c) for c in ("titulo", "tipo")])


@query("canonical_label", "SELECT ordem, tipo, categoria, nivel FROM limpo_catalogo")
def _(L):
    return clean.treat_catalog(L.catalog).select("ordem", "tipo", "categoria", "nivel")


@query("coerce_values", f"SELECT ordem, data_hora, tempo_consumido, CAST(percentual_conclusao AS DOUBLE) AS percentual_conclusao, avaliacao_atribuida FROM limpo_interacoes")
def _(L):
    return clean.treat_interactions(L.raw_interactions).select(
        "ordem", "data_hora", "tempo_consumido", "percentual_conclusao", "avaliacao_atribuida")


@query("normalize_tags", "SELECT ordem, array_to_string(tags, ',') AS tags, len(tags) AS total FROM limpo_comentarios")
def _(L):
    tags = text.normalize_tags(F.col("tags"))
    return L.raw_comments.select("ordem", tags.alias("tags"), F.size(tags).alias("total"))


def treated(L: Layers) -> dict[str, DataFrame]:
    return {
        "catalogo": clean.treat_catalog(L.catalog),
        "interacoes": clean.treat_interactions(L.raw_interactions),
        "comentarios": clean.treat_comments(L.raw_comments),
    }


def corrected(L: Layers) -> DataFrame:
    parts = [clean.count_corrected(rows, name) for name, rows in treated(L).items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


CORRECTED = " UNION ALL ".join(
    f"SELECT '{s}' AS fonte, count(*) AS lidos, count(*) FILTER (WHERE mudou) AS alterados, count(*) FILTER (WHERE vez > 1) AS removidos, "
    f"count(*) FILTER (WHERE mudou) + count(*) FILTER (WHERE vez > 1) AS corrigidos FROM {t}"
    for s, t in (("catalogo", "limpo_catalogo"), ("interacoes", "limpo_interacoes"), ("comentarios", "limpo_comentarios")))
query("count_corrected", CORRECTED)(corrected)


MISSING = {
    "catalogo": ("limpo_catalogo", {"titulo": "titulo", "tipo": "tipo", "categoria": "categoria", "nivel": "nivel", "carga_horaria_min": "carga",
                                    "data_publicacao": "data_publicacao", "descricao": "descricao", "autor": "autor"}),
    "interacoes": ("limpo_interacoes", {c: c for c in ("tipo_interacao", "data_hora", "tempo_consumido", "percentual_conclusao", "avaliacao_atribuida")}),
    "comentarios": ("limpo_comentarios", {c: c for c in ("avaliacao", "comentario", "data")}),
}


@query("count_missing", " UNION ALL ".join(
    f"SELECT '{source}' AS fonte, '{c}' AS coluna, count(*) - count({own}) AS ausentes FROM {table} WHERE vez = 1"
    for source, (table, columns) in MISSING.items() for c, own in columns.items()))
def _(L):
    cleaned = {"catalogo": L.clean_catalog, "interacoes": L.clean_interactions, "comentarios": L.clean_comments}
    return reduce(DataFrame.unionByName, [clean.count_missing(cleaned[source], source, list(columns)) for source, (_, columns) in MISSING.items()])


@query("dedupe_first", "SELECT usuario_id, conteudo_id, data_hora, min(ordem) AS ordem FROM limpo_interacoes GROUP BY ALL")
def _(L):
    return clean.clean_interactions(L.raw_interactions).select("usuario_id", "conteudo_id", "data_hora", "ordem")


query("distinct_users", "SELECT DISTINCT CAST(usuario_id AS BIGINT) AS usuario_id FROM bronze_interacoes")(
    lambda L: clean.distinct_users(L.raw_interactions))

FIT_CATALOG = (f"vez = 1 AND TRY_CAST(conteudo_id AS BIGINT) IS NOT NULL AND titulo IS NOT NULL AND tipo IN {TYPE_LIST} "
               f"AND categoria IN {CAT_LIST} AND nivel IN ('Básico', 'Intermediário', 'Avançado') AND carga >= 0 AND data_publicacao IS NOT NULL")


def loadable(L: Layers) -> DataFrame:
    return load.loadable_catalog(L.clean_catalog)


query("load_filter_catalog", f"SELECT CAST(conteudo_id AS BIGINT) AS conteudo_id, titulo, tipo, categoria, nivel, carga AS carga_horaria_min "
      f"FROM limpo_catalogo WHERE {FIT_CATALOG}")(
    lambda L: loadable(L).select("conteudo_id", "titulo", "tipo", "categoria", "nivel", "carga_horaria_min"))
query("load_filter_interactions", f"""SELECT i.ordem, CAST(i.usuario_id AS BIGINT) AS usuario_id, CAST(i.conteudo_id AS BIGINT) AS conteudo_id,
    i.tipo_interacao, strftime(CAST(i.data_hora AS TIMESTAMP), {INSTANT}) AS data_hora, i.tempo_consumido,
    CAST(i.percentual_conclusao AS DOUBLE) AS percentual_conclusao, i.avaliacao_atribuida FROM limpo_interacoes i
    JOIN (SELECT conteudo_id FROM limpo_catalogo WHERE {FIT_CATALOG}) k ON k.conteudo_id = i.conteudo_id
    WHERE i.vez = 1 AND i.tipo_interacao IN {KIND_LIST} AND i.data_hora IS NOT NULL AND i.tempo_consumido >= 0
      AND i.percentual_conclusao BETWEEN 0 AND 100 AND (i.avaliacao_atribuida IS NULL OR i.avaliacao_atribuida BETWEEN 1 AND 5)""")(
    lambda L: load.loadable_interactions(L.clean_interactions, loadable(L)).select(
        "ordem", "usuario_id", "conteudo_id", "tipo_interacao", F.date_format("data_hora", "yyyy-MM-dd HH:mm:ss").alias("data_hora"),
        "tempo_consumido", F.col("percentual_conclusao").cast("double").alias("percentual_conclusao"), "avaliacao_atribuida"))
query("build_comment_docs", f"SELECT ordem, {S_COMMENT}, categoria FROM documentos")(
    lambda L: load.comment_documents(L.clean_comments, L.clean_catalog))
query("category_dim", f"SELECT list_position([{CAT_LIST[1:-1]}], categoria) AS categoria_id, categoria AS nome FROM silver_conteudo GROUP BY ALL")(
    lambda L: load.category_dimension(L.contents))

# --------------------------------------------------------- silver, quarantine

query("silver_content", f"SELECT {S_CONTENT} FROM silver_conteudo")(
    lambda L: silver.silver_content(L.catalog).select(*CATALOG_COLUMNS))
query("silver_interaction", f"SELECT {S_INTERACTION} FROM silver_interacao")(
    lambda L: silver.silver_interactions(L.raw_interactions, L.contents).select(*INTERACTION_COLUMNS))
query("silver_comment", f"SELECT {S_COMMENT} FROM silver_comentario")(
    lambda L: silver.silver_comments(L.raw_comments, L.contents).select(*COMMENT_COLUMNS))
query("quarantine_split", "SELECT id, registro_id, origem, regra_violada, payload_original FROM rejeitados")(
    lambda L: L.quarantine.select("id", "registro_id", "origem", "regra_violada", "payload_original"))
query("quarantine_rules", "SELECT origem, regra_violada, count(*) AS total FROM rejeitados GROUP BY ALL")(
    lambda L: L.quarantine.groupBy("origem", "regra_violada").agg(F.count(F.lit(1)).alias("total")))
query("quarantine_status", "SELECT origem, 'pendente' AS status, count(*) AS total FROM rejeitados GROUP BY ALL")(
    lambda L: quarantine.status_counts(L.quarantine))


def corrected_catalog_queue(L: Layers) -> DataFrame:
    """Quarantine after someone corrected an unknown type in the payloads."""
    return L.quarantine.withColumn("payload_original", F.replace("payload_original", F.lit("Workshop"), F.lit("Curso")))


PENDING_CATALOG = """(SELECT q.id, q.registro_id, j.conteudo_id, j.tipo, j.categoria, j.nivel, s.conteudo_id AS existe,
    CASE WHEN j.conteudo_id IS NULL THEN 'ID_INVALIDO' WHEN s.conteudo_id IS NOT NULL THEN 'DUPLICADO'
         WHEN coalesce(CASE WHEN j.tipo = 'Workshop' THEN 'Curso' ELSE j.tipo END, '') NOT IN {types} THEN 'TIPO_FORA_DO_DOMINIO'
         WHEN coalesce(j.categoria, '') NOT IN {cats} THEN 'CATEGORIA_FORA_DO_DOMINIO'
         WHEN coalesce(j.nivel, '') NOT IN ('Básico', 'Intermediário', 'Avançado') THEN 'NIVEL_FORA_DO_DOMINIO' END AS regra
    FROM (SELECT registro_id, max(id) AS id FROM rejeitados WHERE origem = 'catalogo' GROUP BY registro_id) q
    JOIN julgado_conteudo j ON j.ordem = q.id LEFT JOIN silver_conteudo s ON s.conteudo_id = j.conteudo_id)""".format(types=TYPE_LIST, cats=CAT_LIST)


@query("reprocess_catalog", f"SELECT coalesce(regra, 'aprovado') AS resultado, count(*) AS total, sum(coalesce(conteudo_id, 0))::BIGINT AS soma_ids "
       f"FROM {PENDING_CATALOG} GROUP BY ALL")
def _(L):
    accepted, _status, renewed = quarantine.reprocess_catalog(corrected_catalog_queue(L), L.contents, "reproc-1")
    ids = accepted.select(F.lit("aprovado").alias("resultado"), "conteudo_id")
    again = renewed.select(
        F.col("regra_violada").alias("resultado"),
        casts.digits_to_long(F.get_json_object("payload_original", "$.conteudo_id")).alias("conteudo_id"),
    )
    return ids.unionByName(again).groupBy("resultado").agg(
        F.count(F.lit(1)).alias("total"), F.sum(F.coalesce("conteudo_id", F.lit(0))).alias("soma_ids"))


@query("reprocess_catalog_status", f"""SELECT CASE WHEN a.registro_id IS NOT NULL THEN 'reprocessado' ELSE 'pendente' END AS status, count(*) AS total
    FROM rejeitados r LEFT JOIN (SELECT registro_id FROM {PENDING_CATALOG} WHERE regra IS NULL) a ON a.registro_id = r.registro_id
    WHERE r.origem = 'catalogo' GROUP BY ALL""")
def _(L):
    status = quarantine.reprocess_catalog(corrected_catalog_queue(L), L.contents, "reproc-1")[1]
    return status.where("origem = 'catalogo'").groupBy("status").agg(F.count(F.lit(1)).alias("total"))


PENDING_INTERACTION = """(SELECT q.id, q.registro_id, j.usuario_id, j.conteudo_id, j.data_hora, j.tempo_consumido,
      row_number() OVER (PARTITION BY j.usuario_id, j.conteudo_id, j.data_hora ORDER BY q.id) AS vez
    FROM (SELECT registro_id, max(id) AS id FROM rejeitados WHERE origem = 'interacoes' GROUP BY registro_id) q
    JOIN julgado_interacao j ON j.ordem = q.id JOIN part p ON p.p_partkey = j.conteudo_id
    WHERE j.usuario_id IS NOT NULL AND j.data_hora IS NOT NULL AND j.percentual_conclusao BETWEEN 0 AND 100 AND j.tipo_interacao IN {kinds}
      AND (j.avaliacao_atribuida IS NULL OR j.avaliacao_atribuida BETWEEN 1 AND 5)
      AND NOT EXISTS (SELECT 1 FROM silver_interacao s WHERE s.usuario_id = j.usuario_id AND s.conteudo_id = j.conteudo_id
                      AND s.data_hora = j.data_hora))""".format(kinds=KIND_LIST)


@query("reprocess_interactions", f"SELECT usuario_id, conteudo_id, strftime(data_hora, {INSTANT}) AS data_hora, tempo_consumido, 'reproc-1' AS execucao_id "
       f"FROM {PENDING_INTERACTION} WHERE vez = 1")
def _(L):
    accepted = quarantine.reprocess_interactions(L.quarantine, L.repaired_contents, L.interactions, "reproc-1")[0]
    return accepted.select("usuario_id", "conteudo_id", "data_hora", "tempo_consumido", "execucao_id")


PENDING_COMMENT = """(SELECT q.id, q.registro_id, j.usuario_id, j.conteudo_id, j.data, j.avaliacao,
      row_number() OVER (PARTITION BY j.usuario_id, j.conteudo_id, j.data ORDER BY q.id) AS vez
    FROM (SELECT registro_id, max(id) AS id FROM rejeitados WHERE origem = 'comentarios' GROUP BY registro_id) q
    JOIN julgado_comentario j ON j.ordem = q.id JOIN part p ON p.p_partkey = j.conteudo_id
    WHERE j.usuario_id IS NOT NULL AND j.data IS NOT NULL AND (j.nota_bruta IS NULL OR j.avaliacao BETWEEN 1 AND 5)
      AND NOT EXISTS (SELECT 1 FROM silver_comentario s WHERE s.usuario_id = j.usuario_id AND s.conteudo_id = j.conteudo_id AND s.data = j.data))"""


@query("reprocess_comments", f"SELECT usuario_id, conteudo_id, strftime(data, {DAY}) AS data, avaliacao FROM {PENDING_COMMENT} WHERE vez = 1")
def _(L):
    accepted = quarantine.reprocess_comments(L.quarantine, L.repaired_contents, L.comments, "reproc-1")[0]
    return accepted.select("usuario_id", "conteudo_id", "data", "avaliacao")


def report_part(origin: str, pending: str) -> str:
    return (f"SELECT r.origem, count(a.registro_id) AS reprocessados, count(*) - count(a.registro_id) AS ainda_pendentes FROM rejeitados r "
            f"LEFT JOIN (SELECT DISTINCT registro_id FROM {pending} WHERE vez = 1) a ON a.registro_id = r.registro_id "
            f"WHERE r.origem = '{origin}' GROUP BY r.origem")


@query("reprocess_report", report_part("interacoes", PENDING_INTERACTION) + " UNION ALL " + report_part("comentarios", PENDING_COMMENT))
def _(L):
    once = quarantine.reprocess_interactions(L.quarantine, L.repaired_contents, L.interactions, "reproc-1")[1]
    twice = quarantine.reprocess_comments(materialize(once, "fila"), L.repaired_contents, L.comments, "reproc-1")[1]
    return quarantine.reprocess_report(twice)


# ------------------------------------------------------------ checks, look-ups

@query("orphans_interactions", "SELECT t.ordem FROM tipado_interacao t LEFT JOIN silver_conteudo c ON c.conteudo_id = t.conteudo_id "
       "WHERE c.conteudo_id IS NULL OR t.usuario_id IS NULL OR t.usuario_id NOT IN (SELECT usuario_id FROM silver_interacao)")
def _(L):
    typed = silver.typed_interaction(L.raw_interactions)
    return lookups.orphan_interactions(typed, L.interactions.select("usuario_id").distinct(), L.contents, "ordem")


@query("orphans_contents", f"SELECT conteudo_id FROM tipado_conteudo WHERE categoria IS NULL OR categoria NOT IN (SELECT DISTINCT categoria FROM silver_conteudo)")
def _(L):
    return lookups.contents_without_category(silver.typed_content(L.catalog), load.category_dimension(L.contents))


@query("orphans_comments", "SELECT t.conteudo_id, count(*) AS comentarios FROM tipado_comentario t LEFT JOIN silver_conteudo c ON c.conteudo_id = t.conteudo_id "
       "WHERE c.conteudo_id IS NULL GROUP BY ALL")
def _(L):
    return lookups.orphan_comments(silver.typed_comment(L.raw_comments), L.contents)


query("contents_without_embedding", "SELECT conteudo_id, titulo FROM silver_conteudo WHERE conteudo_id NOT IN (SELECT vec_id FROM embeddings)")(
    lambda L: lookups.contents_without_embedding(L.contents, L.store))
query("embedding_totals", "SELECT count(*) AS total_embeddings, count(DISTINCT modelo) AS modelos, count(DISTINCT conteudo_id) AS conteudos FROM vetores")(
    lambda L: lookups.embedding_totals(L.store))
query("count_by_model", "SELECT modelo, count(*) AS qtd FROM vetores GROUP BY ALL")(lambda L: lookups.count_by(L.store, "modelo"))
query("embedding_sample", "SELECT conteudo_id, titulo, modelo, len(vetor) AS dimensao FROM vetores JOIN silver_conteudo USING (conteudo_id) ORDER BY conteudo_id LIMIT 5")(
    lambda L: lookups.embedding_sample(L.store, L.contents))
query("completed_leak_check", "SELECT DISTINCT l.usuario_id, l.conteudo_id, l.posicao FROM lote l JOIN silver_interacao i ON i.usuario_id = l.usuario_id "
      "AND i.conteudo_id = l.conteudo_id AND (i.tipo_interacao = 'conclusão' OR i.percentual_conclusao >= 100)")(
    lambda L: lookups.completed_leaks(L.recommendations, L.interactions))
DOCS = f"SELECT {S_COMMENT}, categoria FROM documentos"
NEWEST = "ORDER BY documentos.data DESC, usuario_id, conteudo_id LIMIT 10"
DOC_COLUMNS = [*COMMENT_COLUMNS, "categoria"]
query("comments_of_content", f"{DOCS} WHERE conteudo_id = 91 {NEWEST}")(
    lambda L: L.lookups.comments_of_content(91).select(*DOC_COLUMNS))
query("comments_by_tag", f"{DOCS} WHERE list_contains(documentos.tags, 'assistant') {NEWEST}")(
    lambda L: L.lookups.comments_by_tag("assistant").select(*DOC_COLUMNS))
query("comments_by_rating", f"{DOCS} WHERE avaliacao = 5 {NEWEST}")(
    lambda L: lookups.comments_by_rating(L.documents, 5).select(*DOC_COLUMNS))
query("comments_by_rating_min", f"{DOCS} WHERE avaliacao >= 4 {NEWEST}")(
    lambda L: lookups.comments_by_rating(L.documents, 4, at_least=True).select(*DOC_COLUMNS))
query("comments_per_category", "SELECT categoria, count(*) AS quantidade FROM documentos GROUP BY ALL")(
    lambda L: lookups.comments_per_category(L.documents))


@query("count_by_entity", "SELECT 'usuario' AS entidade, count(DISTINCT usuario_id) AS total FROM silver_interacao "
       "UNION ALL SELECT 'categoria', count(DISTINCT categoria) FROM silver_conteudo UNION ALL SELECT 'conteudo', count(*) FROM silver_conteudo "
       "UNION ALL SELECT 'interacao', count(*) FROM silver_interacao UNION ALL SELECT 'recomendacao', count(*) FROM recomendacao")
def _(L):
    return lookups.count_entities({
        "usuario": L.interactions.select("usuario_id").distinct(), "categoria": load.category_dimension(L.contents),
        "conteudo": L.contents, "interacao": L.interactions, "recomendacao": L.recommendations,
    })


query("count_by_category", "SELECT categoria, count(*) AS qtd FROM silver_conteudo GROUP BY ALL")(lambda L: lookups.count_by(L.contents, "categoria"))
query("count_by_interaction_type", "SELECT tipo_interacao, count(*) AS qtd FROM silver_interacao GROUP BY ALL")(
    lambda L: lookups.count_by(L.interactions, "tipo_interacao"))
query("signal_counts", "SELECT tipo_interacao, count(*) AS qtd FROM silver_interacao WHERE tipo_interacao <> 'compartilhamento' GROUP BY ALL")(
    lambda L: lookups.signal_counts(L.interactions))
query("positive_ratings", "SELECT count(*) AS avaliacoes_positivas FROM silver_interacao WHERE avaliacao_atribuida >= 4")(
    lambda L: lookups.positive_ratings(L.interactions))
query("count_by_batch", f"SELECT strftime(gerado_em, {INSTANT}) AS gerado_em, count(*) AS qtd, count(DISTINCT usuario_id) AS usuarios, "
      "count(*) FILTER (WHERE classificacao = 'Positivo') AS positivas, count(*) FILTER (WHERE classificacao = 'Estável') AS estaveis FROM recomendacao GROUP BY ALL")(
    lambda L: lookups.batch_totals(L.recommendations))
query("count_by_batch_class", "SELECT classificacao, count(*) AS qtd FROM lote GROUP BY ALL")(lambda L: lookups.last_batch_classes(L.recommendations))
query("user_ranking", f"SELECT l.usuario_id, l.posicao, l.conteudo_id, c.titulo, c.categoria, CAST(l.pontuacao AS DOUBLE) AS pontuacao, l.classificacao, "
      f"strftime(l.gerado_em, {INSTANT}) AS gerado_em FROM lote l JOIN silver_conteudo c USING (conteudo_id) WHERE l.usuario_id = {USER}")(
    lambda L: L.lookups.user_ranking(L.contents, USER, L.recommendations.agg(F.max("gerado_em")).first()[0]))
query("completed_by_user", f"SELECT i.conteudo_id, c.titulo, i.tipo_interacao, CAST(i.percentual_conclusao AS DOUBLE) AS percentual_conclusao, count(*) AS vezes "
      f"FROM silver_interacao i JOIN silver_conteudo c USING (conteudo_id) WHERE i.usuario_id = {USER} AND "
      "(i.tipo_interacao = 'conclusão' OR i.percentual_conclusao >= 100) GROUP BY ALL")(
    lambda L: L.lookups.completed_by_user(L.contents, USER))

# ---------------------------------------------------------------------- gold

RUN_SQL = "'carga-1' AS execucao_id"
query("gold_dim_content", f"SELECT conteudo_id, titulo, tipo, categoria, nivel, carga_horaria_min, strftime(data_publicacao, {DAY}) AS data_publicacao, autor, "
      f"origem, arquivo_origem, data_hora_ingestao, execucao_id AS execucao_id_silver, {RUN_SQL} FROM silver_conteudo")(lambda L: L.dimension)
FACT_SQL = (f"SELECT conteudo_id, strftime(data, {DAY}) AS data, total_interacoes, visualizacoes, inicios, conclusoes, curtidas, avaliacoes, "
            f"soma_avaliacao, tempo_total_min, {RUN_SQL} FROM fato")
query("gold_fact_engagement_day", FACT_SQL)(lambda L: L.fact)


def fact_from_months(L: Layers) -> DataFrame:
    """The fact computed again from the month-partitioned export."""
    return gold.fact_engagement_day(month_folder(L), RUN)


query("beam_fact_engagement_day", FACT_SQL.replace(RUN_SQL, RUN_SQL + ", 'spark' AS runner"))(
    lambda L: fact_from_months(L).withColumn("runner", F.lit("spark")))
query("gold_compare_engines", "SELECT count(*) AS linhas_a, count(*) AS linhas_b, 0 AS linhas_diferentes, true AS iguais FROM fato")(
    lambda L: gold.engines_agree(L.gold["fato_engajamento_dia"], fact_from_months(L)))
query("gold_kpi_category", "SELECT categoria, tipo, qtd_conteudos, total_interacoes, visualizacoes, inicios, conclusoes, taxa AS taxa_conclusao_pct, "
      f"nota AS avaliacao_media, tempo AS tempo_medio_min, {RUN_SQL} FROM por_categoria")(lambda L: L.gold["kpi_desempenho_categoria"])
query("gold_kpi_format", "SELECT tipo AS formato, qtd_conteudos, total_interacoes, visualizacoes, inicios, conclusoes, taxa AS taxa_conclusao_pct, "
      f"nota AS avaliacao_media, tempo AS tempo_medio_min, carga AS carga_horaria_media_min, {RUN_SQL} FROM por_formato")(
    lambda L: L.gold["kpi_engajamento_formato"])
query("gold_kpi_day", f"SELECT strftime(data, {DAY}) AS data, total_interacoes, usuarios AS usuarios_ativos, conclusoes, nota AS avaliacao_media, "
      f"coalesce(tempo, 0) AS tempo_total_min, {RUN_SQL} FROM por_dia")(lambda L: L.gold["kpi_evolucao_dia"])


HELD_BACK = "day(data_hora) <= 10 AND conteudo_id % 7 = 0"
STREAM_SQL = f"(SELECT * FROM silver_interacao WHERE NOT ({HELD_BACK}))"


def streamed(L: Layers) -> tuple[str, str]:
    """Interactions as they would arrive in two deliveries, of which the second brings some rows of days long closed."""
    folder = new_folder(L.spark, "chegadas")
    first = F.expr(f"day(data_hora) <= 20 and not ({HELD_BACK})")
    rows = L.interactions.select(*INTERACTION_COLUMNS)
    for part in (rows.where(first), rows.where(~first)):
        part.write.mode("append").parquet(f"{folder}/silver")
        engagement_stream.follow_engagement(
            L.spark, f"{folder}/silver", f"{folder}/fato", f"{folder}/marca", "fluxo", f"{folder}/tardias").awaitTermination()
    return f"{folder}/fato", f"{folder}/tardias"


query("streamed_fact", FACT_SQL.replace(
    "FROM fato", f"""FROM (SELECT conteudo_id, CAST(data_hora AS DATE) AS data, count(*) AS total_interacoes,
        count(*) FILTER (WHERE tipo_interacao = 'visualização') AS visualizacoes, count(*) FILTER (WHERE tipo_interacao = 'início') AS inicios,
        count(*) FILTER (WHERE tipo_interacao = 'conclusão' OR percentual_conclusao >= 100) AS conclusoes,
        count(*) FILTER (WHERE tipo_interacao = 'curtida') AS curtidas, count(avaliacao_atribuida) AS avaliacoes,
        CAST(coalesce(sum(avaliacao_atribuida), 0) AS BIGINT) AS soma_avaliacao, CAST(coalesce(sum(tempo_consumido), 0) AS BIGINT) AS tempo_total_min
        FROM {STREAM_SQL} GROUP BY ALL) f""").replace("strftime(data,", "strftime(f.data,"))(
    lambda L: engagement_stream.streamed_fact(L.spark, streamed(L)[0], RUN))
query("streamed_late_rows", f"SELECT {S_INTERACTION}, 'DIA_FECHADO' AS regra_violada FROM silver_interacao WHERE {HELD_BACK}")(
    lambda L: L.spark.read.parquet(streamed(L)[1]).select(*INTERACTION_COLUMNS, "regra_violada"))


def conversion(L: Layers) -> DataFrame:
    return gold.kpi_rec_conversion(L.recommendations, L.interactions, RUN)


def overall(L: Layers) -> DataFrame:
    return gold.kpi_overall(L.contents, L.interactions, conversion(L), RUN)


query("gold_kpi_rec_conversion", "SELECT total AS total_recomendacoes, usadas AS recomendacoes_com_interacao, taxa AS taxa_conversao_pct, "
      f"lote_gerado_em, {RUN_SQL} FROM conversao")(lambda L: L.gold["kpi_conversao_recomendacao"])
query("gold_kpi_overall", "SELECT g.usuarios AS usuarios_ativos, g.interacoes AS total_interacoes, g.taxa AS taxa_conclusao_pct, g.nota AS avaliacao_media, "
      "g.tempo AS tempo_medio_min, (SELECT count(*) FROM silver_conteudo) AS total_conteudos, v.total AS total_recomendacoes, "
      f"v.taxa AS taxa_conversao_recomendacao_pct, {RUN_SQL} FROM geral g CROSS JOIN conversao v")(lambda L: L.gold["kpi_geral"])

# ----------------------------------------------------------------- KPI views

query("vw_metrics_overall", f"""SELECT g.usuarios AS total_usuarios, g.interacoes AS total_interacoes, g.avaliacoes AS total_avaliacoes,
    g.nota AS avaliacao_media_global, g.conclusoes AS total_conclusoes, g.taxa AS taxa_conclusao_global_pct, g.tempo AS tempo_medio_consumo_min,
    (SELECT count(*) FROM silver_conteudo) AS total_conteudos, (SELECT count(*) FROM lote) AS total_recomendacoes_lote,
    (SELECT {pct("count(*) FILTER (WHERE classificacao = 'Positivo')", "count(*)")} FROM lote) AS taxa_recomendacoes_positivas_pct FROM geral g""")(
    lambda L: kpi.metrics_overall(L.contents, L.interactions, L.recommendations))
query("vw_category_performance", "SELECT categoria AS categoria_nome, tipo AS tipo_conteudo, qtd_conteudos, total_interacoes, visualizacoes, inicios, conclusoes, "
      "curtidas, avaliacoes, taxa AS taxa_conclusao_pct, nota AS avaliacao_media, tempo AS tempo_medio_consumido_min FROM por_categoria")(
    lambda L: kpi.category_performance(L.contents, L.interactions))
DAILY = (f"SELECT strftime(data, {DAY}) AS data, total_interacoes, usuarios AS usuarios_ativos_dia, visualizacoes, inicios, conclusoes, curtidas, avaliacoes, "
         "nota AS avaliacao_media_dia, tempo AS tempo_total_consumido_min FROM por_dia")
query("vw_daily_evolution", DAILY)(lambda L: kpi.daily_evolution(L.interactions))
query("last_10_days", DAILY + " ORDER BY por_dia.data DESC LIMIT 10")(lambda L: kpi.last_days(L.interactions))
query("vw_content_analysis", f"SELECT conteudo_id, titulo, categoria AS categoria_nome, tipo, nivel, carga_horaria_min, strftime(data_publicacao, {DAY}) AS data_publicacao, "
      "autor, total_interacoes, usuarios_distintos, visualizacoes, conclusoes, taxa AS taxa_conclusao_pct, nota AS avaliacao_media, tempo AS tempo_medio_minutos FROM por_conteudo")(
    lambda L: kpi.content_analysis(L.contents, L.interactions))
query("top_contents_by_rate", "SELECT conteudo_id, titulo, categoria AS categoria_nome, tipo, nivel, taxa AS taxa_conclusao_pct, nota AS avaliacao_media FROM por_conteudo "
      "WHERE total_interacoes >= 5 ORDER BY taxa DESC NULLS FIRST, nota DESC NULLS FIRST, conteudo_id LIMIT 5")(
    lambda L: kpi.top_contents_by_rate(L.contents, L.interactions))
query("vw_rec_summary", f"SELECT c.categoria AS categoria_nome, l.classificacao, count(*) AS qtd_recomendacoes, "
      f"{ratio('CAST(sum(CAST(l.pontuacao * 100 AS BIGINT)) AS BIGINT)', 'count(*) * 100', 2)} AS pontuacao_media, CAST(min(l.pontuacao) AS DOUBLE) AS pontuacao_min, "
      f"CAST(max(l.pontuacao) AS DOUBLE) AS pontuacao_max, strftime(max(l.gerado_em), {INSTANT}) AS lote_gerado_em "
      "FROM lote l JOIN silver_conteudo c USING (conteudo_id) GROUP BY ALL")(lambda L: kpi.rec_summary(L.recommendations, L.contents))
query("vw_format_engagement", "SELECT tipo AS formato_conteudo, qtd_conteudos AS total_conteudos_catalogo, total_interacoes, visualizacoes, inicios, conclusoes, "
      "taxa AS taxa_conclusao_pct, nota AS avaliacao_media, tempo AS tempo_medio_consumido_min, carga AS carga_horaria_media_estimada_min FROM por_formato")(
    lambda L: kpi.format_engagement(L.contents, L.interactions))
query("vw_rec_conversion", f"SELECT total AS total_recomendacoes_geradas, usadas AS total_recomendacoes_consumidas, taxa AS taxa_conversao_global_pct, "
      f"positivas AS total_positivas, positivas_usadas AS positivas_consumidas, {pct('positivas_usadas', 'positivas')} AS taxa_conversao_positivos_pct, "
      f"estaveis AS total_estaveis, estaveis_usadas AS estaveis_consumidas, {pct('estaveis_usadas', 'estaveis')} AS taxa_conversao_estaveis_pct FROM conversao")(
    lambda L: kpi.rec_conversion(L.recommendations, L.interactions))
query("vw_rec_selectivity", f"""SELECT '{BATCH}' AS gerado_em, total AS recomendacoes_persistidas, negativas_descartadas - negativas_por_conclusao AS descartadas_pontuacao,
    negativas_por_conclusao AS descartadas_conclusao, total + negativas_descartadas AS total_candidatos_avaliados,
    {pct('total', 'total + negativas_descartadas')} AS taxa_seletividade_pct, {pct('positivas', 'total')} AS taxa_alta_afinidade_pct FROM resumo_rec""")(
    lambda L: kpi.rec_selectivity(recommend.batch_log(recommend.summary(L.blocks, 5), BATCH)))


def ingestion_log(L: Layers) -> DataFrame:
    """Per source: read, classified by the validator, corrected by the cleaner."""
    classes = validate.report_counts(*validated(L)).groupBy("fonte").agg(
        *[F.coalesce(F.sum(F.when(F.col("classificacao") == c, F.col("total"))), F.lit(0)).alias(c)
          for c in ("validos", "invalidos", "incompletos", "duplicados")])
    return corrected(L).select("fonte", "lidos", "corrigidos").join(classes, "fonte")


LOG_SQL = f"""(SELECT c.fonte, c.lidos, c.corrigidos, CAST(coalesce(sum(v.total) FILTER (WHERE classificacao = 'validos'), 0) AS BIGINT) AS validos,
    CAST(coalesce(sum(v.total) FILTER (WHERE classificacao = 'invalidos'), 0) AS BIGINT) AS invalidos,
    CAST(coalesce(sum(v.total) FILTER (WHERE classificacao = 'incompletos'), 0) AS BIGINT) AS incompletos,
    CAST(coalesce(sum(v.total) FILTER (WHERE classificacao = 'duplicados'), 0) AS BIGINT) AS duplicados
    FROM ({CORRECTED}) c JOIN (SELECT fonte, classificacao, count(*) AS total FROM ({V_ALL}) GROUP BY ALL) v ON v.fonte = c.fonte
    GROUP BY c.fonte, c.lidos, c.corrigidos)"""
query("ingestion_summary", f"""SELECT l.fonte, lidos, validos, invalidos, incompletos, duplicados, corrigidos, carregados FROM {LOG_SQL} l JOIN (
    SELECT 'catalogo' AS fonte, count(*) AS carregados FROM ({BODIES["load_filter_catalog"]})
    UNION ALL SELECT 'interacoes', count(*) FROM ({BODIES["load_filter_interactions"]})
    UNION ALL SELECT 'comentarios', count(*) FROM ({BODIES["build_comment_docs"]})) c ON c.fonte = l.fonte""")(
    lambda L: load.ingestion_summary(ingestion_log(L), {
        "catalogo": loadable(L), "interacoes": load.loadable_interactions(L.clean_interactions, loadable(L)), "comentarios": L.documents}))
query("vw_ingestion_quality", f"SELECT fonte, lidos, validos, corrigidos, invalidos, incompletos, duplicados, {pct('corrigidos', 'lidos')} AS taxa_correcao_pct, "
      f"{pct('validos', 'lidos')} AS taxa_conformidade_pct FROM {LOG_SQL}")(
    lambda L: kpi.ingestion_quality(ingestion_log(L).withColumn("id", F.lit(1))))


def listed_sql(section: str, name: str, item: str, measures: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT '{section}' AS secao, {item} AS item, '{m}' AS medida, CAST({m} AS DOUBLE) AS valor FROM ({BODIES[name]})" for m in measures)


query("kpi_summary", " UNION ALL ".join([
    listed_sql("metricas_operacionais", "vw_metrics_overall", "'geral'", kpi.OPERATIONAL),
    listed_sql("kpis_estrategicos", "vw_metrics_overall", "'geral'", kpi.STRATEGIC),
    listed_sql("desempenho_por_categoria", "vw_category_performance", "categoria_nome || ' / ' || tipo_conteudo", kpi.BY_CATEGORY),
    listed_sql("evolucao_temporal_recente", "last_10_days", "data", kpi.BY_DAY),
    listed_sql("distribuicao_recomendacoes", "vw_rec_summary", "categoria_nome || ' / ' || classificacao", kpi.OF_BATCH),
]))(lambda L: kpi.summary_report(L.contents, L.interactions, L.recommendations))


# ---------------------------------------------------------------- dashboards

VDS_DAY = """SELECT f.data, c.categoria, c.tipo, CAST(sum(f.total_interacoes) AS BIGINT) AS total_interacoes, CAST(sum(f.conclusoes) AS BIGINT) AS conclusoes,
    CAST(sum(f.inicios + f.visualizacoes) AS BIGINT) AS inicios_visualizacoes FROM fato f JOIN silver_conteudo c USING (conteudo_id) GROUP BY f.data, c.categoria, c.tipo"""
query("vds_daily_category", f"SELECT strftime(data, {DAY}) AS data, categoria, tipo, total_interacoes, conclusoes, inicios_visualizacoes, "
      f"strftime(date_trunc('month', data), {DAY}) AS mes, CASE WHEN isodow(data) IN (6, 7) THEN 'fim de semana' ELSE 'dia útil' END AS tipo_dia FROM ({VDS_DAY})")(
    lambda L: kpi.daily_category(L.fact, L.dimension))
VDS_MONTH = """SELECT date_trunc('month', f.data) AS mes, c.categoria, CAST(sum(f.conclusoes) AS BIGINT) AS conclusoes,
    CAST(sum(f.inicios + f.visualizacoes) AS BIGINT) AS iv FROM fato f JOIN silver_conteudo c USING (conteudo_id) GROUP BY 1, 2"""
query("vds_monthly_category", f"SELECT strftime(mes, {DAY}) AS mes, categoria, conclusoes, iv AS inicios_visualizacoes, {pct('conclusoes', 'iv')} AS taxa_conclusao_pct, "
      "CASE WHEN iv > 0 AND 100 * conclusoes >= 30 * iv THEN 'alta' WHEN iv > 0 AND 100 * conclusoes >= 20 * iv THEN 'média' ELSE 'baixa' END AS faixa_conclusao "
      f"FROM ({VDS_MONTH})")(lambda L: kpi.monthly_category(L.fact, L.dimension))
query("format_ranking", "SELECT tipo AS formato, qtd_conteudos, total_interacoes, taxa AS taxa_conclusao_pct, nota AS avaliacao_media, "
      "rank() OVER (ORDER BY taxa DESC NULLS FIRST) AS posicao_retencao FROM por_formato")(
    lambda L: kpi.format_ranking(gold.kpi_format(L.contents, L.interactions, RUN)))
query("conversion_status", "SELECT v.total AS total_recomendacoes, v.usadas AS recomendacoes_com_interacao, v.taxa AS taxa_conversao_pct, g.usuarios AS usuarios_ativos, "
      "CASE WHEN v.taxa < 8 THEN 'dispara alerta' ELSE 'dentro da meta' END AS situacao, strftime(v.instante, '%Y-%m-%d %H:%M') AS lote_recomendacao "
      "FROM conversao v CROSS JOIN geral g")(lambda L: kpi.conversion_status(conversion(L), overall(L)))
query("alert_rec_conversion", "SELECT taxa AS valor, CAST(8 AS DOUBLE) AS limite, coalesce(taxa < 8, false) AS dispara FROM conversao")(
    lambda L: kpi.alert_rec_conversion(conversion(L)))
query("tile_active_users", "SELECT usuarios AS usuarios_ativos FROM geral")(lambda L: kpi.tile_active_users(overall(L)))
query("tile_sum_by_date", f"SELECT strftime(data, {DAY}) AS data, CAST(sum(total_interacoes) AS BIGINT) AS total_interacoes FROM ({VDS_DAY}) "
      "WHERE data >= DATE '2024-01-05' AND data < DATE '2024-01-25' AND categoria IN ('Banco de Dados', 'DevOps & Cloud') AND tipo IN ('Artigo') GROUP BY ALL")(
    lambda L: kpi.tile_sum_by_date(kpi.daily_category(L.fact, L.dimension), ("2024-01-05", "2024-01-25"), ["Banco de Dados", "DevOps & Cloud"], ["Artigo"]))
query("tile_sum_by_category", "SELECT categoria, CAST(sum(total_interacoes) AS BIGINT) AS total_interacoes FROM por_categoria GROUP BY ALL")(
    lambda L: kpi.tile_sum_by_category(gold.kpi_category(L.contents, L.interactions, RUN)))
query("tile_rate_by_category", "SELECT categoria, tipo, taxa AS taxa_conclusao_pct FROM por_categoria")(
    lambda L: kpi.tile_rate_by_category(gold.kpi_category(L.contents, L.interactions, RUN)))

# ------------------------------------------------------------------- quality


def test_results(L: Layers) -> DataFrame:
    return quality.run_tests(L.contents, L.interactions, L.comments, RUN)


query("dq_completeness_title", "SELECT completude AS completude_titulo FROM medidas")(lambda L: quality.title_completeness(L.contents))
query("dq_validity_percent", "SELECT validade AS validade_percentual FROM medidas")(
    lambda L: quality.interaction_measures(L.interactions).select("validade_percentual"))
query("dq_uniqueness_interaction", "SELECT unicidade AS unicidade_interacao FROM medidas")(
    lambda L: quality.interaction_measures(L.interactions).select("unicidade_interacao"))
query("dq_consistency_conclusion", "SELECT consistencia AS consistencia_conclusao FROM medidas")(
    lambda L: quality.interaction_measures(L.interactions).select("consistencia_conclusao"))
query("dq_integrity_comment", "SELECT integridade AS integridade_comentario_conteudo FROM medidas")(
    lambda L: quality.comment_integrity(L.comments, L.contents))
CONCLUDED_ROWS = "count(*) FILTER (WHERE tipo_interacao = 'conclusão')"
COMPLETE_ROWS = "count(*) FILTER (WHERE tipo_interacao = 'conclusão' AND percentual_conclusao >= 100)"
query("dq_raw_interactions", "SELECT CAST(count(*) FILTER (WHERE percentual_conclusao > 100 OR percentual_conclusao < 0) AS DOUBLE) AS validade_percentual, "
      "CAST(count(*) - count(DISTINCT (usuario_id, conteudo_id, data_hora)) AS DOUBLE) AS unicidade_interacao, "
      f"{pct(COMPLETE_ROWS, CONCLUDED_ROWS)} AS consistencia_conclusao FROM tipado_interacao")(
    lambda L: quality.interaction_measures(silver.typed_interaction(L.raw_interactions)))

DQ_ROWS = " UNION ALL ".join(
    f"SELECT 'carga-1' AS execucao_id, '{t[0]}' AS fonte, '{name}' AS teste, '{t[1]}' AS dimensao, {col} AS valor, CAST({t[3]} AS DOUBLE) AS limite, "
    f"'{t[4]}' AS operador, '{t[5]}' AS severidade, {col} {t[4]} {t[3]} AS aprovado, '{t[6]}' AS acao FROM medidas"
    for (name, t), col in zip(quality.TESTS.items(), ("completude", "validade", "unicidade", "consistencia", "integridade")))
def texts_sql(rows: str) -> str:
    """The results with the fixed texts of each test."""
    said = ", ".join(f"('{name}', '{t[2]}', '{t[7]}')" for name, t in quality.TESTS.items())
    return f"SELECT r.*, t.formula, t.mensagem FROM ({rows}) r JOIN (VALUES {said}) t(teste, formula, mensagem) ON t.teste = r.teste"


query("dq_run", texts_sql(DQ_ROWS))(lambda L: L.results)
query("dq_stored_tables", texts_sql(DQ_ROWS))(test_results)
query("dq_verdict", f"SELECT execucao_id, CASE WHEN bool_and(aprovado) THEN 'sucesso' ELSE 'sucesso com ressalvas' END AS resultado FROM ({DQ_ROWS}) GROUP BY ALL")(
    lambda L: quality.verdict(L.results))
query("dq_gate", f"SELECT 'carga-1' AS execucao_id, CASE WHEN count(*) FILTER (WHERE NOT aprovado AND severidade = 'critica') = 0 THEN 'liberado' ELSE 'bloqueado' END AS situacao "
      f"FROM ({DQ_ROWS})")(lambda L: quality.gate(L.results, RUN).select("execucao_id", "situacao"))
query("dq_history", f"SELECT execucao_id, teste, fonte, valor, limite, aprovado FROM ({DQ_ROWS}) WHERE teste IN ('completude_titulo', 'consistencia_conclusao')")(
    lambda L: quality.history(L.results))


@query("dq_gate_blocked", "SELECT 'carga-1' AS execucao_id, 'bloqueado' AS situacao, 'publicacao gold bloqueada: teste critico reprovado "
       "(unicidade_interacao, validade_percentual) na execucao carga-1' AS motivo FROM tipado_interacao LIMIT 1")
def _(L):
    measures = quality.interaction_measures(silver.typed_interaction(L.raw_interactions))
    return quality.gate(quality.describe_results(measures, RUN), RUN)


@query("sink_quality_json", texts_sql(DQ_ROWS))
def _(L):
    path = new_folder(L.spark, "qualidade_json")
    writers.write_json(L.results, path)
    return L.spark.read.schema(L.results.schema).json(path)


AUDIT_RUN = "dia-2024-01-15"


@query("audit_stage_summary", f"""SELECT etapa, strftime(inicio, {INSTANT}) AS inicio, strftime(fim, {INSTANT}) AS fim,
    round((epoch_us(fim) - epoch_us(inicio)) / 1000000.0, 3) AS duracao_segundos, resultado,
    CASE WHEN bool_or(resultado = 'falha') OVER () THEN 'falha' WHEN bool_or(resultado = 'sucesso com ressalvas') OVER () THEN 'sucesso com ressalvas' ELSE 'sucesso' END
      AS resultado_final, '{AUDIT_RUN}' AS execucao_id
    FROM (SELECT event_type AS etapa, min(ts) FILTER (WHERE event_id % 2 = 0) AS inicio, max(ts) FILTER (WHERE event_id % 2 = 1) AS fim,
            max(CASE WHEN value > 450 THEN 'falha' WHEN value > 300 THEN 'sucesso com ressalvas' ELSE 'sucesso' END) FILTER (WHERE event_id % 2 = 1) AS resultado
          FROM events WHERE 'dia-' || strftime(ts, '%Y-%m-%d') = '{AUDIT_RUN}' GROUP BY event_type)""")
def _(L):
    stages = given.table(L.spark, L.sf_dir, "events").select(
        F.expr("concat('dia-', date_format(ts, 'yyyy-MM-dd'))").alias("execucao_id"), F.col("event_type").alias("etapa"),
        F.expr("case when event_id % 2 = 0 then 'inicio' else 'fim' end").alias("evento"),
        F.expr("""case when event_id % 2 = 1 then case when value > 450 then 'falha' when value > 300 then 'sucesso com ressalvas'
                       else 'sucesso' end end""").alias("resultado"),
        F.col("ts").alias("instante"))
    return audit.stage_summary(stages, L.quarantine, AUDIT_RUN)


GOLD_QUERIES = {
    "dim_conteudo": ("gold_dim_content", 13), "fato_engajamento_dia": ("gold_fact_engagement_day", 11), "kpi_desempenho_categoria": ("gold_kpi_category", 11),
    "kpi_engajamento_formato": ("gold_kpi_format", 11), "kpi_evolucao_dia": ("gold_kpi_day", 7),
    "kpi_conversao_recomendacao": ("gold_kpi_rec_conversion", 5), "kpi_geral": ("gold_kpi_overall", 9)}


@query("table_metadata_snapshot", """SELECT 'carga-1' AS execucao_id, 'silver' AS esquema, 'conteudo' AS tabela, count(*) AS linhas, 13 AS colunas FROM silver_conteudo
    UNION ALL SELECT 'carga-1', 'silver', 'interacao', count(*), 11 FROM silver_interacao
    UNION ALL SELECT 'carga-1', 'silver', 'comentario', count(*), 10 FROM silver_comentario""" + "".join(
    f" UNION ALL SELECT 'carga-1', 'gold', '{table}', count(*), {columns} FROM ({BODIES[name]})" for table, (name, columns) in GOLD_QUERIES.items()))
def _(L):
    silver_tables = {"silver.conteudo": L.contents, "silver.interacao": L.interactions, "silver.comentario": L.comments}
    return lookups.table_snapshot(silver_tables | {f"gold.{name}": rows for name, rows in L.gold.items()}, RUN)


CLASSIFIED = [
    ("bronze", "interacoes", "usuario_id", "bronze_interacoes", governance.INDIRECT), ("bronze", "comentarios", "usuario_id", "bronze_comentarios", governance.INDIRECT),
    ("bronze", "comentarios", "comentario", "bronze_comentarios", governance.SENSITIVE), ("bronze", "catalogo", "autor", "bronze_catalogo", governance.PERSONAL),
    ("silver", "interacao", "usuario_id", "silver_interacao", governance.INDIRECT), ("silver", "comentario", "usuario_id", "silver_comentario", governance.INDIRECT),
    ("silver", "comentario", "comentario", "silver_comentario", governance.SENSITIVE), ("silver", "conteudo", "autor", "silver_conteudo", governance.PERSONAL),
    ("gold", "dim_conteudo", "autor", "silver_conteudo", governance.PERSONAL),
]


@query("column_classification", " UNION ALL ".join(
    f"SELECT '{schema}' AS esquema, '{table}' AS tabela, '{c}' AS coluna, count({c}) AS preenchidos, '{tag}' AS classificacao FROM {rows}"
    for schema, table, c, rows, tag in CLASSIFIED) + f""" UNION ALL SELECT 'lgpd', 'vw_interacao_pseudonimizada', 'pseudo_id', count(*), 'Pseudonimizado' FROM silver_interacao
    UNION ALL SELECT 'lgpd', 'vw_comentario_mascarado', 'pseudo_id', count(*), 'Pseudonimizado' FROM silver_comentario
    UNION ALL SELECT 'lgpd', 'vw_comentario_mascarado', 'comentario_mascarado', count(comentario), 'Mascarado' FROM silver_comentario
    UNION ALL SELECT 'lgpd', 'conteudo_publico', 'autor_mascarado', count(autor), 'Mascarado' FROM silver_conteudo
    UNION ALL SELECT 'lgpd', 'conteudo_publico', 'autor_hash', count(autor), 'HashComSalt' FROM silver_conteudo""")
def _(L):
    return governance.classified_columns({
        "bronze.interacoes": L.raw_interactions, "bronze.comentarios": L.raw_comments, "bronze.catalogo": L.catalog,
        "silver.interacao": L.interactions, "silver.comentario": L.comments, "silver.conteudo": L.contents,
        **{f"gold.{name}": rows for name, rows in L.gold.items()},
        "lgpd.vw_interacao_pseudonimizada": privacy.interactions_pseudonymised(L.interactions, pseudonyms(L)),
        "lgpd.vw_comentario_mascarado": privacy.comments_masked(L.comments, pseudonyms(L)),
        "lgpd.conteudo_publico": privacy.public_content(L.dimension, SALT)})


def same_columns(table: str, columns: list[str]) -> dict[str, list[str]]:
    return {c: [f"{table}.{c}"] for c in columns}


KIND, COMPLETED, RATED, MINUTES = (
    ["silver.interacao.tipo_interacao"], ["silver.interacao.percentual_conclusao", "silver.interacao.tipo_interacao"],
    ["silver.interacao.avaliacao_atribuida"], ["silver.interacao.tempo_consumido"])
RATES = {"taxa_conclusao_pct": COMPLETED, "avaliacao_media": RATED, "tempo_medio_min": MINUTES}
STARTED = {"visualizacoes": KIND, "inicios": KIND, "conclusoes": COMPLETED}
# What each column of a table is made from, and the query that has the table's rows.
MADE_FROM = {
    "silver.conteudo": ("silver_conteudo", same_columns("bronze.catalogo", [*CATALOG_COLUMNS, *AUDIT_COLUMNS])),
    "silver.interacao": ("silver_interacao", same_columns("bronze.interacoes", [*INTERACTION_COLUMNS, *AUDIT_COLUMNS])),
    "silver.comentario": ("silver_comentario", same_columns("bronze.comentarios", [*COMMENT_COLUMNS, *AUDIT_COLUMNS])),
    "gold.dim_conteudo": ("gold_dim_content", same_columns(
        "silver.conteudo", [c for c in [*CATALOG_COLUMNS, *AUDIT_COLUMNS] if c not in ("descricao", "execucao_id")]) | {"execucao_id_silver": ["silver.conteudo.execucao_id"]}),
    "gold.fato_engajamento_dia": ("gold_fact_engagement_day", STARTED | {
        "conteudo_id": ["silver.interacao.conteudo_id"], "data": ["silver.interacao.data_hora"], "curtidas": KIND, "avaliacoes": RATED,
        "soma_avaliacao": RATED, "tempo_total_min": MINUTES}),
    "gold.kpi_desempenho_categoria": ("gold_kpi_category", STARTED | RATES | same_columns("silver.conteudo", ["categoria", "tipo"])),
    "gold.kpi_engajamento_formato": ("gold_kpi_format", STARTED | RATES | {
        "formato": ["silver.conteudo.tipo"], "carga_horaria_media_min": ["silver.conteudo.carga_horaria_min"]}),
    "gold.kpi_evolucao_dia": ("gold_kpi_day", {
        "data": ["silver.interacao.data_hora"], "usuarios_ativos": ["silver.interacao.usuario_id"], "conclusoes": COMPLETED, "avaliacao_media": RATED,
        "tempo_total_min": MINUTES}),
    "gold.kpi_conversao_recomendacao": ("gold_kpi_rec_conversion", {"lote_gerado_em": ["recomendacao.lotes.gerado_em"]}),
    "gold.kpi_geral": ("gold_kpi_overall", RATES | {"usuarios_ativos": ["silver.interacao.usuario_id"]}),
}
EDGES_SQL = ", ".join(
    "('{}', '{}', '{}', '{}')".format(*origin.rsplit(".", 1), table, column)
    for table, (_, columns) in MADE_FROM.items() for column, origins in columns.items() for origin in origins)


def filled_sql(table: str, source: str, columns: list[str]) -> str:
    """How many values of each column are filled."""
    rows = source if source not in BODIES else f"({BODIES[source]})"
    counts = ", ".join(("count(*)" if c in AUDIT_COLUMNS else f"count(t.{c})") + f" AS {c}" for c in columns)
    return f"SELECT '{table}' AS destino_tabela, destino_coluna, linhas FROM (UNPIVOT (SELECT {counts} FROM {rows} t) ON COLUMNS(*) INTO NAME destino_coluna VALUE linhas)"


def lineage_tables(L: Layers) -> tuple[dict[str, DataFrame], dict[str, DataFrame], dict[str, str]]:
    """Tables as they are defined over stored ones, the same tables as they are stored, and the folder of each stored one."""
    sources = {
        "bronze.catalogo": L.catalog, "bronze.interacoes": L.raw_interactions, "bronze.comentarios": L.raw_comments, "silver.conteudo": L.contents,
        "silver.interacao": L.interactions, "silver.comentario": L.comments, "recomendacao.lotes": L.recommendations}
    rate = conversion(L)
    made = {
        "silver.conteudo": silver.silver_content(L.catalog), "silver.interacao": silver.silver_interactions(L.raw_interactions, L.contents),
        "silver.comentario": silver.silver_comments(L.raw_comments, L.contents), "gold.dim_conteudo": L.dimension, "gold.fato_engajamento_dia": L.fact,
        "gold.kpi_desempenho_categoria": gold.kpi_category(L.contents, L.interactions, RUN),
        "gold.kpi_engajamento_formato": gold.kpi_format(L.contents, L.interactions, RUN), "gold.kpi_evolucao_dia": gold.kpi_day(L.interactions, RUN),
        "gold.kpi_conversao_recomendacao": rate, "gold.kpi_geral": gold.kpi_overall(L.contents, L.interactions, rate, RUN)}
    stored = {n: t for n, t in sources.items() if n.startswith("silver.")} | {f"gold.{n}": t for n, t in L.gold.items()}
    return made, stored, {n: t.inputFiles()[0].rsplit("/", 1)[0] for n, t in sources.items() if t.inputFiles()}


@query("column_lineage", f"SELECT e.*, f.linhas FROM (VALUES {EDGES_SQL}) e(origem_tabela, origem_coluna, destino_tabela, destino_coluna) JOIN ("
       + " UNION ALL ".join(filled_sql(t, source, list(columns)) for t, (source, columns) in MADE_FROM.items())
       + ") f ON f.destino_tabela = e.destino_tabela AND f.destino_coluna = e.destino_coluna")
def _(L):
    made, stored, folders = lineage_tables(L)
    return column_lineage.carried(column_lineage.edges(L.spark, made, folders), stored)


@query("lineage_closure", f"""SELECT s.*, (SELECT count(*) FROM bronze_catalogo) > 0 AS com_dados FROM (
    WITH RECURSIVE e(origem_tabela, origem_coluna, destino_tabela, destino_coluna) AS (VALUES {EDGES_SQL}), r AS (
      SELECT *, 1 AS distancia FROM e UNION
      SELECT e.origem_tabela, e.origem_coluna, r.destino_tabela, r.destino_coluna, r.distancia + 1 FROM r JOIN e
        ON e.destino_tabela = r.origem_tabela AND e.destino_coluna = r.origem_coluna)
    SELECT origem_tabela, origem_coluna, destino_tabela, destino_coluna, min(distancia) AS distancia FROM r GROUP BY ALL) s""")
def _(L):
    made, _, folders = lineage_tables(L)
    return column_lineage.closure(column_lineage.edges(L.spark, made, folders)).withColumn("com_dados", F.lit(not L.catalog.isEmpty()))


# --------------------------------------------------------------- master data

query("mdm_category_crosswalk", "SELECT trim(b.categoria) AS valor_origem, min(c.categoria) AS categoria_canonica FROM bronze_catalogo b "
      "JOIN silver_conteudo c ON TRY_CAST(b.conteudo_id AS BIGINT) = c.conteudo_id GROUP BY 1")(
    lambda L: master_data.category_crosswalk(L.catalog, L.contents))
query("mdm_groups", "SELECT primeiro, max(tamanho) AS qtd_registros, max(conteudo_id) FILTER (WHERE recencia = 1) AS mais_recente FROM grupo GROUP BY primeiro")(
    lambda L: master_data.keyed(L.contents).groupBy("_chave").agg(
        F.min("conteudo_id").alias("primeiro"), F.count(F.lit(1)).alias("qtd_registros"),
        F.max_by("conteudo_id", F.struct(F.coalesce("data_publicacao", F.lit("0001-01-01").cast("date")), "conteudo_id")).alias("mais_recente"),
    ).drop("_chave"))
query("mdm_master", f"SELECT mestre_id, titulo, tipo, categoria, nivel, carga_horaria_min, strftime(data_publicacao, {DAY}) AS data_publicacao, qtd_registros FROM mestre")(
    lambda L: master_data.master(L.contents))
query("mdm_crosswalk", "SELECT g.conteudo_id, m.mestre_id, CASE WHEN g.tamanho = 1 THEN 'unico' ELSE 'titulo_normalizado+tipo+autor' END AS regra_match, "
      "g.cadastro = 1 AS sobrevivente FROM grupo g JOIN mestre m ON m.primeiro = g.primeiro")(lambda L: master_data.crosswalk(L.contents))
query("mdm_kept_master", BODIES["mdm_master"])(lambda L: master_data_runs.master(L.spark, L.masters))
query("mdm_kept_crosswalk", BODIES["mdm_crosswalk"])(lambda L: master_data_runs.crosswalk(L.spark, L.masters))
query("mdm_conflicts", f"""SELECT m.mestre_id, g.conteudo_id, g.cadastro = 1 AS sobrevivente, g.titulo, g.tipo, g.categoria, g.nivel AS nivel_origem, m.nivel AS nivel_mestre,
    g.carga_horaria_min AS carga_origem, m.carga_horaria_min AS carga_mestre, strftime(g.data_publicacao, {DAY}) AS data_origem,
    strftime(m.data_publicacao, {DAY}) AS data_mestre FROM grupo g JOIN mestre m ON m.primeiro = g.primeiro WHERE g.tamanho > 1""")(
    lambda L: master_data.conflicts(L.contents))
query("mdm_counts", "SELECT CAST(sum(qtd_registros) AS BIGINT) AS registros_origem, count(*) AS mestres, count(*) FILTER (WHERE qtd_registros > 1) AS grupos_com_conflito FROM mestre")(
    lambda L: master_data.counts(L.contents))
query("mdm_normalize", "SELECT conteudo_id, kt AS titulo, ka AS autor FROM chaves")(
    lambda L: L.contents.select("conteudo_id", text.match_text(F.col("titulo")).alias("titulo"), text.match_text(F.col("autor")).alias("autor")))

# ------------------------------------------------------------------- privacy


def pseudonyms(L: Layers) -> DataFrame:
    """The kept map after two runs: one over the users of comments, one over all; the second draws only for those it adds."""
    return L.pseudonyms[1]


UUID = r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"


@query("pseudonym_map", """SELECT u.usuario_id, true AS valido, 1 AS usuarios_por_pseudonimo, c.usuario_id IS NOT NULL AS da_primeira_carga, true AS mantido
    FROM (SELECT usuario_id FROM silver_interacao UNION SELECT usuario_id FROM silver_comentario) u
    LEFT JOIN (SELECT DISTINCT usuario_id FROM silver_comentario) c ON c.usuario_id = u.usuario_id""")
def _(L):
    first, whole = L.pseudonyms
    earlier = first.select("usuario_id", F.col("pseudo_id").alias("antes"))
    shared = whole.groupBy("pseudo_id").agg(F.count(F.lit(1)).alias("usuarios_por_pseudonimo"))
    return whole.join(shared, "pseudo_id").join(earlier, "usuario_id", "left").select(
        "usuario_id", F.col("pseudo_id").rlike(UUID).alias("valido"), "usuarios_por_pseudonimo", F.col("antes").isNotNull().alias("da_primeira_carga"),
        F.coalesce(F.col("antes") == F.col("pseudo_id"), F.lit(True)).alias("mantido"))


def told_apart(L: Layers, rows: DataFrame) -> DataFrame:
    """Pseudonyms exchanged for the users they stand for, by the map of the same runs, so that rows can be compared by user."""
    return rows.join(pseudonyms(L), "pseudo_id").drop("pseudo_id")


@query("interactions_pseudonymised", "SELECT usuario_id, conteudo_id, tipo_interacao, strftime(data_hora, '%Y-%m-%d') AS data, tempo_consumido, "
       "CAST(percentual_conclusao AS DOUBLE) AS percentual_conclusao, avaliacao_atribuida FROM silver_interacao")
def _(L):
    return told_apart(L, privacy.interactions_pseudonymised(L.interactions, pseudonyms(L)))


@query("comments_masked", f"SELECT usuario_id, conteudo_id, avaliacao, CASE WHEN length(comentario) <= 20 THEN comentario ELSE substr(comentario, 1, 20) || '...' END AS comentario_mascarado, "
       f"strftime(data, {DAY}) AS data FROM silver_comentario")
def _(L):
    return told_apart(L, privacy.comments_masked(L.comments, pseudonyms(L)))


MASKED = "array_to_string(list_transform(string_split_regex(trim(autor), '\\s+'), lambda p: substr(p, 1, 1) || '***'), ' ')"
PUBLIC = (f"SELECT conteudo_id, titulo, tipo, categoria, nivel, {MASKED} AS autor_mascarado, sha256('{SALT}|' || lower(trim(autor))) AS autor_hash FROM silver_conteudo")
query("public_content", PUBLIC)(lambda L: privacy.public_content(L.dimension, SALT))
query("mask_name", f"SELECT conteudo_id, {MASKED} AS autor_mascarado FROM silver_conteudo")(
    lambda L: L.contents.select("conteudo_id", text.mask_name(F.col("autor")).alias("autor_mascarado")))
query("mask_text", "SELECT ordem, CASE WHEN length(comentario) <= 20 THEN comentario ELSE substr(comentario, 1, 20) || '...' END AS comentario FROM bronze_comentarios")(
    lambda L: L.raw_comments.select("ordem", text.mask_text(F.col("comentario")).alias("comentario")))


@query("privacy_check", "SELECT 'nome do autor visivel no valor publicado' AS verificacao, count(*) FILTER (WHERE autor_mascarado = autor) AS violacoes "
       f"FROM ({PUBLIC}) JOIN (SELECT conteudo_id, autor FROM silver_conteudo) USING (conteudo_id) "
       "UNION ALL SELECT 'coluna identificadora em tabela publicada', 0")
def _(L):
    public, names = privacy.public_content(L.dimension, SALT), pseudonyms(L)
    published = {"conteudo_publico": public, "interacoes": privacy.interactions_pseudonymised(L.interactions, names),
                 "comentarios": privacy.comments_masked(L.comments, names)}
    return privacy.leak_check(public, L.dimension, published)


# ---------------------------------------------------- embeddings, search

query("text_repr", "SELECT conteudo_id, texto AS texto_origem FROM textos JOIN silver_conteudo USING (conteudo_id)")(
    lambda L: search.content_texts(L.contents))
query("embedding_delta", "SELECT conteudo_id, texto_origem, situacao FROM delta")(
    lambda L: search.embedding_delta(L.contents, L.stored_texts, MODEL))
query("embedding_delta_report", "SELECT situacao, count(*) AS total FROM delta GROUP BY ALL")(
    lambda L: search.delta_report(search.embedding_delta(L.contents, L.stored_texts, MODEL)))


@query("embed_batch", "SELECT conteudo_id, texto_origem, 'base' AS modelo, vetor, 64 AS dimensao, CAST(1 AS DOUBLE) AS norma FROM codificados")
def _(L):
    from cascata.functions.vectors import norm

    delta = search.embedding_delta(L.contents, L.stored_texts, MODEL)
    made = search.embed_pending(delta, search.hashing_encoder(DIMENSION), MODEL)
    return made.select("conteudo_id", "texto_origem", "modelo", "vetor", F.size("vetor").alias("dimensao"), F.round(norm(F.col("vetor")), 4).alias("norma"))


def hits_sql(query_vector: str, where: str, k: int) -> str:
    return f"""SELECT v.conteudo_id, list_cosine_similarity(v.vetor, {query_vector}) AS s, row_number() OVER (ORDER BY
        round(list_cosine_similarity(v.vetor, {query_vector}), 12) DESC, v.conteudo_id) AS posicao
        FROM vetores v JOIN silver_conteudo k ON k.conteudo_id = v.conteudo_id WHERE {where} ORDER BY posicao LIMIT {k}"""


def vector_sql(vec: int) -> str:
    return f"(SELECT CAST(embedding AS DOUBLE[]) FROM embeddings WHERE vec_id = {vec})"


FOUND = "h.posicao, h.conteudo_id, c.titulo, c.categoria, c.tipo, round(h.s, 4) AS similaridade, round(1 - h.s, 4) AS distancia"


def query_vector(L: Layers, vec: int) -> list[float]:
    found = search.vector_of(L.store, vec)
    if found is None:
        raise ValueError(f"vetor {vec} inexistente")
    return found


query("semantic_search", f"SELECT {FOUND} FROM ({hits_sql(vector_sql(QUERY_VECTORS[0]), chr(39).join(['v.modelo = ', 'base', '']), 5)}) h JOIN silver_conteudo c USING (conteudo_id)")(
    lambda L: search.semantic_search(L.store, L.contents, query_vector(L, QUERY_VECTORS[0]), 5, MODEL))
query("semantic_search_batch", " UNION ALL ".join(
    f"SELECT 'q{v}' AS consulta, {FOUND} FROM ({hits_sql(vector_sql(v), chr(39).join(['v.modelo = ', 'base', '']), 5)}) h JOIN silver_conteudo c USING (conteudo_id)"
    for v in QUERY_VECTORS))(
    lambda L: search.semantic_search_batch(L.store, L.contents, {f"q{v}": query_vector(L, v) for v in QUERY_VECTORS}, 5, MODEL))


@query("ann_search", f"SELECT {FOUND} FROM ({hits_sql(vector_sql(QUERY_VECTORS[1]), chr(39).join(['v.modelo = ', 'base', '']), 5)}) h JOIN silver_conteudo c USING (conteudo_id)")
def _(L):
    path = new_folder(L.spark, "indice")
    known = L.store.join(L.contents.select("conteudo_id"), "conteudo_id", "left_semi")
    vector_index.build_index(known, MODEL, DIMENSION, path)
    return vector_index.indexed_search(L.spark, path, L.contents, query_vector(L, QUERY_VECTORS[1]), 5)


@query("ann_search_batch", """SELECT 'c' || q AS consulta, h.posicao, h.conteudo_id, c.titulo, c.categoria, c.tipo, round(h.s, 4) AS similaridade, round(1 - h.s, 4) AS distancia
    FROM (SELECT a.conteudo_id AS q, v.conteudo_id, list_cosine_similarity(v.vetor, a.vetor) AS s, row_number() OVER (PARTITION BY a.conteudo_id ORDER BY
            round(list_cosine_similarity(v.vetor, a.vetor), 12) DESC, v.conteudo_id) AS posicao
          FROM vetores a JOIN vetores v ON v.modelo = 'base' JOIN silver_conteudo k ON k.conteudo_id = v.conteudo_id
          WHERE a.conteudo_id % 50 = 0) h JOIN silver_conteudo c ON c.conteudo_id = h.conteudo_id WHERE h.posicao <= 5""")
def _(L):
    """Neighbours of many stored vectors at once, through the index."""
    path = new_folder(L.spark, "indice")
    vector_index.build_index(L.store.join(L.contents.select("conteudo_id"), "conteudo_id", "left_semi"), MODEL, DIMENSION, path)
    asked = L.store.where("conteudo_id % 50 = 0").select(F.concat(F.lit("c"), "conteudo_id").alias("consulta"), "vetor")
    return vector_index.indexed_search_batch(L.spark, path, L.contents, asked, 5)


query("similar_contents", f"SELECT {FOUND} FROM ({hits_sql(vector_sql(CONTENT), 'true', 5)}) h JOIN silver_conteudo c USING (conteudo_id)")(
    lambda L: search.similar_contents(L.store, L.contents, CONTENT, 5))
PROFILE = f"""(SELECT list(m ORDER BY d) FROM (SELECT t.d, avg(v.vetor[t.d]) AS m FROM silver_interacao i JOIN vetores v USING (conteudo_id),
    (SELECT unnest(range(1, 65)) AS d) t WHERE i.usuario_id = {USER} AND i.tipo_interacao IN ('visualização', 'início', 'conclusão') GROUP BY t.d))"""
NOT_DONE = (f"v.conteudo_id NOT IN (SELECT conteudo_id FROM silver_interacao WHERE usuario_id = {USER} AND (tipo_interacao = 'conclusão' OR percentual_conclusao >= 100))")
query("user_profile_neighbours", f"SELECT h.posicao, h.conteudo_id, c.titulo, c.categoria, round(h.s, 4) AS ivis FROM ({hits_sql(PROFILE, NOT_DONE, 5)}) h JOIN silver_conteudo c USING (conteudo_id)")(
    lambda L: search.profile_neighbours(L.interactions, L.store, L.contents, USER, 5))

# -------------------------------------------------------------- recommender

query("rec_signals", "SELECT usuario_id, conteudo_id, CAST(peso AS BIGINT) AS peso, positivo, concluido FROM sinais")(
    lambda L: recommend.signals(L.interactions))


def centroid_query(name: str, column: str):
    sql = f"""SELECT usuario_id, generate_subscripts({column}, 1) - 1 AS pos, round(unnest({column}) / sqrt(list_dot_product({column}, {column})), 6) AS valor FROM centroide_{column}"""

    def run(L: Layers) -> DataFrame:
        pairs, measured = recommend.signals(L.interactions), recommend.measured_vectors(L.store, MODEL)
        made = recommend.centroid_views(pairs, measured) if column == "vis" else recommend.centroid_likes(pairs, measured)
        return scaled_to_unit(made, column).select("usuario_id", F.posexplode(column).alias("pos", "valor")).withColumn("valor", F.round("valor", 6))

    query(name, sql)(run)


centroid_query("rec_centroid_views", "vis")
centroid_query("rec_centroid_likes", "cur")
query("rec_category_share", "SELECT usuario_id, categoria, round(parte_tempo, 9) AS parte_tempo, round(parte_positivos, 9) AS parte_positivos FROM cotas WHERE categoria IS NOT NULL")(
    lambda L: recommend.category_shares(recommend.signals(L.interactions), L.contents).select(
        "usuario_id", "categoria", F.round("parte_tempo", 9).alias("parte_tempo"), F.round("parte_positivos", 9).alias("parte_positivos")))


@query("rec_score", "SELECT usuario_id, conteudo_id, CAST(pontuacao AS DOUBLE) AS pontuacao, round_even(ivis, 4) AS ivis, round_even(icur, 4) AS icur, iconc, classificacao FROM classes WHERE tocado")
def _(L):
    pairs = materialize(recommend.signals(L.interactions), "sinais")
    measured = recommend.measured_vectors(L.store, MODEL, DIMENSION)
    return recommend.score_pairs(pairs, recommend.user_profiles(pairs, L.contents, measured), recommend.content_matrix(L.contents, measured), DIMENSION)


query("rec_classify", "SELECT event_id AS ordem, CASE WHEN event_id % 11 = 0 OR value / 5 <= 40 THEN 'Negativo' WHEN value / 5 >= 70 THEN 'Positivo' ELSE 'Estável' END AS classificacao FROM events")(
    lambda L: given.table(L.spark, L.sf_dir, "events").select(
        F.col("event_id").alias("ordem"),
        recommend.classify(F.col("value") / 5, F.when(F.col("event_id") % 11 == 0, 0).otherwise(1)).alias("classificacao")))
TOP = (f"SELECT usuario_id, conteudo_id, titulo, categoria, tipo, CAST(pontuacao AS DOUBLE) AS pontuacao, classificacao, round_even(ivis, 4) AS ivis, round_even(icur, 4) AS icur, "
       f"iconc, posicao, '{BATCH}' AS gerado_em FROM melhores")
query("rec_top_n", TOP)(lambda L: recommend.top_n(L.blocks, L.contents, 5, BATCH))
query("rec_summary", "SELECT * FROM resumo_rec")(lambda L: recommend.summary(L.blocks, 5))
query("rec_for_user", f"{TOP} WHERE usuario_id = {USER}")(
    lambda L: recommend.for_user(L.interactions, L.contents, L.store, USER, MODEL, DIMENSION, 5, BATCH))

# ------------------------------------------------------------------ reports


def as_json(L: Layers, rows: DataFrame, label: str) -> DataFrame:
    """A report as it is read back from its JSON."""
    path = new_folder(L.spark, label)
    writers.write_json(rows, path)
    return L.spark.read.schema(rows.schema).json(path)


query("sink_kpi_json", BODIES["kpi_summary"])(lambda L: as_json(L, kpi.summary_report(L.contents, L.interactions, L.recommendations), "kpis_json"))
query("sink_ingestion_json", BODIES["ingestion_summary"])(lambda L: as_json(L, QUERIES["ingestion_summary"].run(L), "resumo_json"))
query("sink_search_json", BODIES["semantic_search_batch"])(lambda L: as_json(L, QUERIES["semantic_search_batch"].run(L), "busca_json"))
query("sink_recommendation_json", BODIES["rec_top_n"])(lambda L: as_json(L, QUERIES["rec_top_n"].run(L), "recomendacoes_json"))
