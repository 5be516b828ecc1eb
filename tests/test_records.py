"""Rules, validator and cleaner on small literal rows."""

import pytest
from pyspark.sql import functions as F

from cascata.functions import casts, text
from cascata.operators import clean, silver, validate
from cascata.operators.skew import lookup, mark_repeats
from cascata.schemas import CATALOG_COLUMNS, COMMENT_COLUMNS, INTERACTION_COLUMNS

AUDIT = ("fonte", "arquivo", "2024-01-01T00:00:00", "run-1")


def frame(spark, columns, rows):
    names = ["ordem", *columns, "origem", "arquivo_origem", "data_hora_ingestao", "execucao_id"]
    kinds = ", ".join(f"{n} {'bigint' if n == 'ordem' else 'string'}" for n in names)
    return spark.createDataFrame([(i, *r, *AUDIT) for i, r in enumerate(rows)], kinds)


def content(cid, titulo="Titulo", tipo="Curso", categoria="Banco de Dados", nivel="Básico", carga="30",
            data="2024-01-01", descricao="d", autor="Ana Lima"):
    return (cid, titulo, tipo, categoria, nivel, carga, data, descricao, autor)


def interaction(user="1", cid="1", tipo="início", data="2024-01-01T10:00:00", tempo="5", perc="10", nota=None):
    return (user, cid, tipo, data, tempo, perc, nota)


def rules_of(judged):
    return [r["regra_violada"] for r in judged.orderBy("ordem").collect()]


@pytest.fixture(scope="module")
def contents(spark):
    return silver.silver_content(frame(spark, CATALOG_COLUMNS, [content("1"), content("2")]))


def test_content_rules(spark):
    rows = [content("x"), content("1", tipo="Workshop"), content("1"), content("2", tipo=" VIDEO "),
            content("3", categoria="ciencia de dados"), content("4", categoria="Culinária"), content("5", nivel="Mestre"),
            content(None), content("6", carga="-5", data="2024-02-30")]
    judged = silver.judge_content(frame(spark, CATALOG_COLUMNS, rows))
    assert rules_of(judged) == ["ID_INVALIDO", "TIPO_FORA_DO_DOMINIO", "DUPLICADO", None, None,
                                "CATEGORIA_FORA_DO_DOMINIO", "NIVEL_FORA_DO_DOMINIO", "ID_INVALIDO", None]
    kept = {r["conteudo_id"]: r for r in judged.where("regra_violada is null").collect()}
    assert (kept[2]["tipo"], kept[3]["categoria"]) == ("Vídeo", "Ciência de Dados")
    assert kept[6]["carga_horaria_min"] is None and kept[6]["data_publicacao"] is None


def test_interaction_rules_in_order(spark, contents):
    rows = [
        interaction(user="0"), interaction(cid="99"), interaction(), interaction(), interaction(data="2024-02-30"),
        interaction(data="2024-02-30"), interaction(tipo="error", data="2024-01-02"), interaction(data="2024-01-03", perc="101"),
        interaction(data="2024-01-04", nota="9"), interaction(data="2024-01-05 08:00:00", tempo="-3", perc="57.555", nota="4.5"),
    ]
    judged = silver.judge_interactions(frame(spark, INTERACTION_COLUMNS, rows), contents)
    assert rules_of(judged) == [
        "USUARIO_INVALIDO", "REFERENCIA_INEXISTENTE", None, "DUPLICADO", "DATA_INVALIDA", "DUPLICADO",
        "TIPO_INTERACAO_FORA_DO_DOMINIO", "PERCENTUAL_FORA_DA_FAIXA", "AVALIACAO_FORA_DA_FAIXA", None]
    last = judged.where("ordem = 9").first()
    assert last["tempo_consumido"] is None and float(last["percentual_conclusao"]) == 57.56
    assert last["avaliacao_atribuida"] == 5
    assert judged.where("ordem = 1").first()["registro_id"] == "interacoes:usuario_id=1,conteudo_id=99,data_hora=2024-01-01T10:00:00"


def test_duplicate_counts_even_when_the_first_is_rejected(spark, contents):
    rows = [interaction(tipo="error"), interaction()]
    assert rules_of(silver.judge_interactions(frame(spark, INTERACTION_COLUMNS, rows), contents)) == [
        "TIPO_INTERACAO_FORA_DO_DOMINIO", "DUPLICADO"]


def test_comment_rules(spark, contents):
    rows = [("1", "1", "5", "bom", '["A "," b","a"]', "2024-01-01"), ("1", "1", "otimo", "x", "oops", "2024-01-02"),
            ("1", "2", None, None, None, "2024-01-01"), ("1", "2", "3", "x", "[]", "ontem")]
    judged = silver.judge_comments(frame(spark, COMMENT_COLUMNS, rows), contents)
    assert rules_of(judged) == [None, "AVALIACAO_FORA_DA_FAIXA", None, "DATA_INVALIDA"]
    assert [r["tags"] for r in judged.orderBy("ordem").collect()] == [["a", "b"], [], [], []]


def test_payload_keeps_the_raw_row(spark):
    raw = frame(spark, CATALOG_COLUMNS, [content("x", titulo=None), content("1")])
    judged = silver.judge_content(raw)
    assert "payload_original" not in judged.columns
    payload = silver.to_quarantine(judged, "catalogo", raw).first()["payload_original"]
    assert payload.startswith('{"conteudo_id":"x","titulo":null,')


@pytest.mark.parametrize("value, expected", [("2026-8-5", True), ("2026-02-30", False), ("05/08/2026", False),
                                             ("2026-08-05T00:00:00", False), ("nan", False), ("", False), (None, False)])
def test_date_format(spark, value, expected):
    row = spark.createDataFrame([(value,)], "v string").select(casts.matches_date_format(F.col("v")).alias("ok")).first()
    assert row["ok"] is expected


def test_clean_text_and_labels(spark):
    rows = spark.createDataFrame([("  a\t",), ("nan",), (" None ",), ("",), (None,), ("banana",)], "v string")
    assert [r[0] for r in rows.select(text.clean_text(F.col("v"))).collect()] == ["a", None, None, None, None, "banana"]
    labels = spark.createDataFrame([(" VÍDEO",), ("video",)], "v string")
    assert [r[0] for r in labels.select(text.canonical_label(F.col("v"), ["Vídeo"])).collect()] == ["Vídeo", "video"]
    assert [r[0] for r in labels.select(text.official_label(F.trim("v"), ["Vídeo"])).collect()] == ["Vídeo", "Vídeo"]


def test_masks(spark):
    rows = spark.createDataFrame([("Ana  Lima", "x" * 21), ("  ", "curto"), (None, None)], "n string, t string")
    made = rows.select(text.mask_name(F.col("n")).alias("n"), text.mask_text(F.col("t")).alias("t")).collect()
    assert [tuple(r) for r in made] == [("A*** L***", "x" * 20 + "..."), (None, "curto"), (None, None)]


def test_validator_classes(spark):
    catalog = frame(spark, CATALOG_COLUMNS, [content("1"), content("1"), content("2", titulo=None, nivel=None),
                                             content("3", tipo="curso", carga="abc", data="01/02/2024")])
    made = {r["ordem"]: (r["classificacao"], r["motivo"]) for r in validate.validate_catalog(catalog).collect()}
    assert made[0] == ("validos", None)
    assert made[1] == ("duplicados", "conteudo_id duplicado")
    assert made[2] == ("incompletos", "campos ausentes: ['titulo', 'nivel']")
    assert made[3] == ("invalidos", "tipo invalido: curso; carga_horaria nao-numerica: abc; data_publicacao em formato "
                                    "invalido: 01/02/2024 (esperado YYYY-MM-DD)")
    inter = frame(spark, INTERACTION_COLUMNS, [interaction(), interaction(cid="77", perc="101", nota="9", data="2024-01-02")])
    made = {r["ordem"]: r for r in validate.validate_interactions(inter, catalog).collect()}
    assert made[0]["classificacao"] == "validos"
    assert made[1]["motivo"] == ("conteudo_id inexistente: 77; percentual fora de 0-100: 101.0; avaliacao fora de 1-5: 9; "
                                 "data_hora em formato invalido: 2024-01-02 (esperado YYYY-MM-DDTHH:MM:SS)")
    comments = frame(spark, COMMENT_COLUMNS, [("9", "1", "5", "", "[]", "2024-01-01"), ("9", "1", "5", "x", "oops", "2024-01-02")])
    made = {r["ordem"]: r for r in validate.validate_comments(comments, catalog, inter).collect()}
    assert made[0]["motivo"] == "campos ausentes: ['comentario']"
    assert made[1]["motivo"] == "usuario_id inexistente: 9; tags nao e lista"


def test_cleaner_counts_changes_and_duplicates(spark):
    raw = frame(spark, INTERACTION_COLUMNS, [interaction(), interaction(nota="5.0"), interaction(tipo=" INÍCIO", data="2024-01-09T00:00:00")])
    counted = clean.count_corrected(clean.treat_interactions(raw), "interacoes").first()
    assert (counted["alterados"], counted["removidos"], counted["corrigidos"]) == (2, 1, 3)
    assert clean.clean_interactions(raw).count() == 2


def test_repeats_and_lookup_survive_a_hot_key(spark):
    rows = spark.range(3000).select(F.col("id").alias("ordem"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"))
    marked = mark_repeats(rows, ["k"], "ordem")
    assert marked.where("not repetida").count() == rows.select("k").distinct().count()
    assert marked.where("k = 7 and not repetida").collect()[0]["ordem"] == 0
    dim = spark.createDataFrame([(7, "sete")], "k bigint, nome string")
    joined = lookup(rows, dim, ["k"])
    assert joined.count() == 3000
    assert joined.where("nome = 'sete'").count() == rows.where("k = 7").count()


def test_lookups_never_broadcast_what_grows(spark):
    """Files of few bytes may hold many rows, so a dimension is not sent to the driver by the size of its files."""
    from cascata.operators.skew import lookup

    facts, dimension = spark.range(10).withColumnRenamed("id", "conteudo_id"), spark.range(5).withColumnRenamed("id", "conteudo_id")
    for how, rows in (("left", 10), ("inner", 5), ("left_semi", 5), ("left_anti", 5)):
        joined = lookup(facts, dimension, ["conteudo_id"], how)
        assert joined.count() == rows
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_first_rows_are_not_broadcast(spark):
    """There are as many firsts as keys, so they are not sent to the driver either."""
    from cascata.operators.skew import mark_repeats, newest_per_key

    rows = spark.createDataFrame([(0, 1), (1, 1), (2, None), (3, None), (4, 2)], "ordem long, chave long")
    marked, newest = mark_repeats(rows, ["chave"], "ordem"), newest_per_key(rows, ["chave"], "ordem")
    assert sorted((r.ordem, r.repetida) for r in marked.collect()) == [(0, False), (1, True), (2, False), (3, True), (4, False)]
    assert sorted(r.ordem for r in newest.collect()) == [1, 3, 4]
    for made in (marked, newest):
        assert "BroadcastHashJoin" not in made._jdf.queryExecution().executedPlan().toString()


WHOLE_OR_ROUNDED = [
    ("12", 12, 12), ("007", 7, 7), ("-5", None, -5), ("-0", 0, 0), ("-0.4", 0, 0), ("2.5", 3, 3), ("-2.5", None, -3), ("1.", None, None), ("+5", None, None), ("1e3", None, None),
    ("9223372036854775807", 9223372036854775807, 9223372036854775807), ("9223372036854775808", None, None), ("9223372036854775807.4", 9223372036854775807, 9223372036854775807),
    ("12\n", 12, 12), ("", None, None), ("٣", None, None), (None, None, None), ("9" * 40, None, None),
]


def test_whole_numbers_are_read_without_decimals_and_mean_the_same(spark):
    rows = spark.createDataFrame([(i, *r) for i, r in enumerate(WHOLE_OR_ROUNDED)], "i int, v string, positivo bigint, inteiro bigint")
    v = F.col("v")
    made = rows.select("*", casts.rounded_not_negative(v).alias("p"), casts.rounded_long(v).alias("n"))
    assert made.where("not (p <=> positivo and n <=> inteiro)").collect() == []
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("coalesce(try_cast(v") == 2  # the decimals are asked only where that gives nothing


def test_ids_and_instants_ignore_blanks_at_their_ends(spark):
    rows = spark.createDataFrame([("  42 ", "2024-01-02 03:04:05"), ("0", "2024-01-02T03:04:05"), (" 0001", "2024-01-02"), ("4 2", "2024-02-30"), ("-1", "2024-01-02  03:04:05")], "i string, t string")
    made = rows.select(casts.digits_to_long(F.col("i")), casts.positive_id(F.col("i")), F.date_format(casts.iso_timestamp(F.col("t")), "dd HH:mm:ss"))
    assert [tuple(r) for r in made.collect()] == [
        (42, 42, "02 03:04:05"), (0, None, "02 03:04:05"), (1, 1, "02 00:00:00"), (None, None, None), (None, None, None)]


def test_an_interaction_field_is_trimmed_once(spark):
    rows = frame(spark, INTERACTION_COLUMNS, [("1", "1", " Curtida ", " 2024-01-02 ", " 3 ", " 4.5 ", " 5 ")])
    typed = silver.typed_interaction(rows.localCheckpoint())
    plan = typed._jdf.queryExecution().optimizedPlan().toString()
    assert all(plan.count(f"trim({c}#") == 1 for c in INTERACTION_COLUMNS[2:])
    found = typed.first().asDict()
    assert found["tipo_interacao"] == "curtida" and found["_data_bruta"] == "2024-01-02" and found["avaliacao_atribuida"] == 5
    assert not [c for c in typed.columns if c.startswith("_campo")]
