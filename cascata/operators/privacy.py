"""Privacy: pseudonyms, masked and hashed authors, truncated comments, and the leak check."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cascata.functions.text import mask_name, mask_text, salted_hash
from cascata.operators.skew import lookup
from cascata.session import materialize, scratch
from cascata.sources import keyed, versions
from cascata.sources.versions import CommitConflict, Version

FORBIDDEN_COLUMNS = {"usuario_id", "autor", "comentario"}


def known_users(interactions: DataFrame, comments: DataFrame) -> DataFrame:
    return interactions.select("usuario_id").union(comments.select("usuario_id")).distinct()


def new_pseudonyms(users: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """A random pseudonym for each user that has none.

    The values are random, so the result must be written (or checkpointed) before it is
    used twice; existing pseudonyms are never drawn again.
    """
    fresh = users if existing is None else users.join(existing.select("usuario_id"), "usuario_id", "left_anti")
    return fresh.select("usuario_id", F.uuid().alias("pseudo_id"))


PSEUDONYMS = "usuario_id long, pseudo_id string"


def keep_pseudonyms(spark: SparkSession, base: str, users: DataFrame, run_id: str) -> Version:
    """Give every user without a pseudonym one, for good.

    A run draws for the users that the kept map lacks, stores what it drew, and inserts what is still
    absent. If another run commits first, the map is read again and only what it still lacks is
    inserted: the first committed value of a user stays, and a repeated run adds nothing.
    """
    table = "pseudonimos"
    if table not in versions.newest(spark, base).tables:
        try:
            keyed.create(spark.createDataFrame([], PSEUDONYMS), base, table, ["usuario_id"], run_id)
        except CommitConflict:
            pass  # another run has begun the map
    with scratch(spark):
        drawn = materialize(new_pseudonyms(users, kept_pseudonyms(spark, base)), table)
        while True:
            try:
                return keyed.insert_absent(spark, base, table, drawn, run_id)
            except CommitConflict:
                continue


def kept_pseudonyms(spark: SparkSession, base: str, version: Version | None = None) -> DataFrame:
    return keyed.read(spark, base, "pseudonimos", version)


def check_salt(salt: str | None) -> str:
    if salt is None or len(salt) < 16:
        raise ValueError("salt ausente ou curto (minimo 16 caracteres)")
    return salt


def public_content(dimension: DataFrame, salt: str) -> DataFrame:
    salt = check_salt(salt)
    return dimension.select(
        "conteudo_id", "titulo", "tipo", "categoria", "nivel",
        mask_name(F.col("autor")).alias("autor_mascarado"),
        salted_hash(F.lower(F.trim("autor")), salt).alias("autor_hash"),
    )


def interactions_pseudonymised(interactions: DataFrame, pseudonyms: DataFrame) -> DataFrame:
    """A user may hold much of the rows; the join leaves it to Spark to split them."""
    joined = lookup(interactions, pseudonyms.select("usuario_id", "pseudo_id"), ["usuario_id"], "inner")
    return joined.select(
        "pseudo_id", "conteudo_id", "tipo_interacao", F.to_date("data_hora").alias("data"),
        "tempo_consumido", "percentual_conclusao", "avaliacao_atribuida",
    )


def comments_masked(comments: DataFrame, pseudonyms: DataFrame) -> DataFrame:
    joined = lookup(comments, pseudonyms.select("usuario_id", "pseudo_id"), ["usuario_id"], "inner")
    return joined.select(
        "pseudo_id", "conteudo_id", "avaliacao", mask_text(F.col("comentario")).alias("comentario_mascarado"), "data"
    )


def leak_check(public: DataFrame, dimension: DataFrame, published: dict[str, DataFrame]) -> DataFrame:
    """Original authors among published values, and forbidden columns in published tables."""
    pairs = public.join(dimension.select("conteudo_id", "autor"), "conteudo_id")
    same = (F.col("autor_mascarado") == F.col("autor")) | (F.col("autor_hash") == F.col("autor"))
    values = pairs.agg(F.count_if(same).alias("violacoes")).select(
        F.lit("nome do autor visivel no valor publicado").alias("verificacao"), "violacoes"
    )
    exposed = sum(len(FORBIDDEN_COLUMNS & set(df.columns)) for df in published.values())
    columns = values.select(
        F.lit("coluna identificadora em tabela publicada").alias("verificacao"),
        F.lit(exposed).cast("bigint").alias("violacoes"),
    )
    return values.unionByName(columns)
