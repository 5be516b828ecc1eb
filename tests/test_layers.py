"""Quarantine, quality gate, Gold publication, master data, privacy, merge and the whole run."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cascata.operators import audit, gold, governance, kpi, master_data, merge, privacy, quality, quarantine, silver
from cascata.operators.skew import lookup
from cascata.plans import registry
from cascata.plans.layers import Layers
from cascata.plans.medallion import GOLD_TABLES, Paths, Run, run_medallion
from cascata.schemas import CATALOG_COLUMNS, COMMENT_COLUMNS
from cascata.session import new_folder
from cascata.sources import files, writers

CONTENT = "conteudo_id bigint, titulo string, tipo string, categoria string, nivel string, carga_horaria_min bigint, data_publicacao date, descricao string, autor string"
INTERACTION = "usuario_id bigint, conteudo_id bigint, tipo_interacao string, data_hora timestamp_ntz, tempo_consumido bigint, percentual_conclusao double, avaliacao_atribuida bigint"
COMMENT = "usuario_id bigint, conteudo_id bigint, avaliacao bigint, comentario string, data date"
DAY = dt.datetime(2024, 1, 1)


def contents(spark, rows=((1, "Titulo"), (2, "Outro"))):
    return spark.createDataFrame([(i, t, "Curso", "Banco de Dados", "Básico", 30, DAY.date(), None, "Ana") for i, t in rows], CONTENT)


def interactions(spark, extra=()):
    rows = [(1, 1, "início", DAY, 10, 0.0, None), (1, 1, "conclusão", DAY + dt.timedelta(days=1), 20, 100.0, 5), *extra]
    return spark.createDataFrame(rows, INTERACTION)


def comments(spark, cid=1):
    return spark.createDataFrame([(1, cid, 5, "bom", DAY.date())], COMMENT)


def failed(results):
    return [r["teste"] for r in results.where("not aprovado").collect()]


def test_clean_data_passes_every_test(spark):
    results = quality.run_tests(contents(spark), interactions(spark), comments(spark), "run-1")
    assert results.count() == 5 and failed(results) == []
    assert quality.verdict(results).first()["resultado"] == "sucesso"
    assert quality.enforce_gate(results, "run-1") == "liberado"


@pytest.mark.parametrize("broken, test", [
    (lambda s: (contents(s, ((1, " "), (2, "x"))), interactions(s), comments(s)), "completude_titulo"),
    (lambda s: (contents(s), interactions(s, [(2, 2, "início", DAY, 1, 120.0, None)]), comments(s)), "validade_percentual"),
    (lambda s: (contents(s), interactions(s, [(1, 1, "início", DAY, 1, 0.0, None)]), comments(s)), "unicidade_interacao"),
    (lambda s: (contents(s), interactions(s, [(2, 2, "conclusão", DAY, 1, 50.0, None)]), comments(s)), "consistencia_conclusao"),
    (lambda s: (contents(s), interactions(s), comments(s, 77)), "integridade_comentario_conteudo"),
])
def test_each_violation_flips_one_test(spark, broken, test):
    results = quality.run_tests(*broken(spark), "run-1")
    assert failed(results) == [test]
    critical = quality.TESTS[test][5] == "critica"
    if critical:
        with pytest.raises(quality.GateBlocked, match=test):
            quality.enforce_gate(results, "run-1")
    else:
        assert quality.enforce_gate(results, "run-1") == "liberado"
        assert quality.verdict(results).first()["resultado"] == "sucesso com ressalvas"


def test_empty_inputs(spark):
    results = quality.run_tests(contents(spark).limit(0), interactions(spark).limit(0), comments(spark).limit(0), "r")
    values = {r["teste"]: r["valor"] for r in results.collect()}
    assert values == {"completude_titulo": 0, "validade_percentual": 0, "unicidade_interacao": 0,
                      "consistencia_conclusao": 100, "integridade_comentario_conteudo": 0}
    with pytest.raises(quality.GateBlocked, match="sem resultado"):
        quality.enforce_gate(results, "outra")


def test_results_of_a_run_are_replaced(spark):
    first = quality.run_tests(contents(spark), interactions(spark), comments(spark), "a")
    stored = quality.replace_run(first, first.withColumn("valor", F.lit(1.0)), "a")
    assert stored.count() == 5 and stored.agg(F.sum("valor")).first()[0] == 5


@pytest.mark.parametrize("run_id", [None, " ", "a b", "x;y"])
def test_bad_run_ids(run_id):
    with pytest.raises(ValueError):
        quality.check_run_id(run_id)


def test_run_id_is_made_when_blank():
    assert len(quality.new_run_id("")) == 36 and quality.new_run_id("carga:1.0") == "carga:1.0"


def entry(i, rid, source, payload):
    return (i, rid, source, "REGRA", "m", "run-1", payload, "pendente")


def queue(spark, rows):
    return spark.createDataFrame(rows, "id bigint, registro_id string, origem string, regra_violada string, mensagem string, "
                                       "execucao_id string, payload_original string, status string")


def catalog_payload(cid, tipo):
    return ('{"conteudo_id":"%s","titulo":"t","tipo":"%s","categoria":"Banco de Dados","nivel":"Básico","carga_horaria_min":"10",'
            '"data_publicacao":"2024-01-01","descricao":null,"autor":"a","origem":"catalogo","arquivo_origem":"f",'
            '"data_hora_ingestao":"2024-01-01T00:00:00","execucao_id":"b-1"}' % (cid, tipo))


def test_reprocess_catalog_three_cases(spark):
    rows = [entry(1, "c:9001", "catalogo", catalog_payload(9001, "Workshop")), entry(2, "c:9001", "catalogo", catalog_payload(9001, "curso")),
            entry(3, "c:9002", "catalogo", catalog_payload(9002, "Workshop")), entry(4, "c:1", "catalogo", catalog_payload(1, "Curso"))]
    accepted, status, renewed = quarantine.reprocess_catalog(queue(spark, rows), contents(spark), "reproc-1")
    assert [r["conteudo_id"] for r in accepted.collect()] == [9001]
    assert {r["id"]: r["status"] for r in status.collect()} == {1: "reprocessado", 2: "reprocessado", 3: "pendente", 4: "pendente"}
    assert {(r["registro_id"], r["regra_violada"], r["execucao_id"]) for r in renewed.collect()} == {
        ("c:9002", "TIPO_FORA_DO_DOMINIO", "reproc-1"), ("c:1", "DUPLICADO", "reproc-1")}


def inter_payload(user, cid, tipo):
    return ('{"usuario_id":"%s","conteudo_id":"%s","tipo_interacao":"%s","data_hora":"2024-05-01T00:00:00","tempo_consumido":"3",'
            '"percentual_conclusao":"10","avaliacao_atribuida":null}' % (user, cid, tipo))


def test_reprocess_interactions_collisions_enter_once(spark):
    rows = [entry(1, "i:a", "interacoes", inter_payload(5, 1, "INICIO")), entry(2, "i:b", "interacoes", inter_payload("5 ", 1, "curtida")),
            entry(3, "i:c", "interacoes", inter_payload(6, 99, "curtida"))]
    accepted, status = quarantine.reprocess_interactions(queue(spark, rows), contents(spark), interactions(spark), "reproc-1")
    assert [(r["usuario_id"], r["tipo_interacao"]) for r in accepted.collect()] == [(5, "início")]
    report = quarantine.reprocess_report(status).first()
    assert (report["reprocessados"], report["ainda_pendentes"]) == (1, 2)


def test_master_data_survivorship(spark):
    d = dt.date
    rows = [(39, "Introdução  à SQL", "Curso", "Banco de Dados", "Básico", None, d(2023, 1, 1), None, "Ana Lima"),
            (480, "introducao a sql", "Curso", "DevOps & Cloud", "Avançado", 50, d(2024, 1, 1), None, "ana lima"),
            (7, "introducao a sql", "Curso", "DevOps & Cloud", "Básico", 10, None, None, "Outro Autor"),
            (8, None, "Curso", "DevOps & Cloud", "Básico", 10, None, None, None), (9, None, "Curso", "Banco de Dados", "Básico", None, None, None, None)]
    made = {r["mestre_id"]: r for r in master_data.master(spark.createDataFrame(rows, CONTENT)).collect()}
    merged = made["CNT-00039"]
    assert (merged["titulo"], merged["categoria"], merged["nivel"], merged["carga_horaria_min"]) == (
        "Introdução  à SQL", "Banco de Dados", "Avançado", 50)
    assert made["CNT-00008"]["qtd_registros"] == 2 and made["CNT-00008"]["carga_horaria_min"] == 10
    links = {r["conteudo_id"]: (r["mestre_id"], r["regra_match"], r["sobrevivente"]) for r in master_data.crosswalk(spark.createDataFrame(rows, CONTENT)).collect()}
    assert links[480] == ("CNT-00039", "titulo_normalizado+tipo+autor", False) and links[7] == ("CNT-00007", "unico", True)


def test_privacy(spark):
    dimension = contents(spark)
    with pytest.raises(ValueError):
        privacy.public_content(dimension, "curto")
    public = privacy.public_content(dimension, "x" * 16)
    assert public.first()["autor_mascarado"] == "A***" and len(public.first()["autor_hash"]) == 64
    assert [r["violacoes"] for r in privacy.leak_check(public, dimension, {"p": public}).collect()] == [0, 0]
    assert [r["violacoes"] for r in privacy.leak_check(public, dimension, {"p": dimension}).collect()] == [0, 1]
    users = privacy.known_users(interactions(spark), comments(spark))
    kept = privacy.new_pseudonyms(users)
    assert kept.count() == 1 and privacy.new_pseudonyms(users, kept.select("usuario_id")).count() == 0


def test_merge(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    updates = spark.createDataFrame([(2, "c", 1), (3, "d", 2), (3, "e", 3)], "k int, v string, o int")
    latest = merge.last_per_key(updates, ["k"], "o")
    assert sorted(tuple(r) for r in merge.upsert(target, latest, ["k"]).collect()) == [(1, "a"), (2, "c"), (3, "e")]
    assert sorted(tuple(r) for r in merge.insert_absent(target, latest, ["k"]).collect()) == [(1, "a"), (2, "b"), (3, "e")]


def test_month_slice_prunes_folders(spark):
    path = new_folder(spark, "meses")
    rows = interactions(spark, [(2, 2, "início", dt.datetime(2024, 3, 5), 1, 0.0, None)])
    writers.write_month_partitions(rows, path)
    march = writers.month_slice(writers.read_month_partitions(spark, path, rows.schema), "03")
    assert [(r["usuario_id"], r["mes"]) for r in march.collect()] == [(2, "03")]
    plan = march._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(mes" in plan
    assert "ano" not in rows.columns


def test_fact_engines_compare(spark):
    fact = gold.fact_engagement_day(interactions(spark), "r")
    same = gold.engines_agree(fact, fact).first()
    assert same["iguais"] and same["linhas_a"] == same["linhas_b"] == 2
    other = gold.engines_agree(fact, fact.withColumn("curtidas", F.lit(9).cast("bigint"))).first()
    assert not other["iguais"] and other["linhas_diferentes"] == 4


def test_alert_and_tier(spark):
    kpis = spark.createDataFrame([(7.5,)], "taxa_conversao_pct double")
    assert kpi.alert_rec_conversion(kpis).first()["dispara"] is True
    assert kpi.alert_rec_conversion(spark.createDataFrame([(None,)], "taxa_conversao_pct double")).first()["dispara"] is False
    rows = spark.createDataFrame([(3, 10), (2, 10), (1, 10), (1, 0)], "p int, w int")
    assert [r[0] for r in rows.select(kpi.rate_tier(F.col("p"), F.col("w"))).collect()] == ["alta", "média", "baixa", "baixa"]


def test_governance(spark):
    base = new_folder(spark, "linhagem")
    folders = {name: f"{base}/{name}" for name in ("bronze.interacoes", "silver.interacao", "silver.conteudo")}
    raw = spark.createDataFrame([(1, 2, "Ana")], "usuario_id bigint, conteudo_id bigint, autor string")
    raw.write.parquet(folders["bronze.interacoes"])
    raw.select("conteudo_id", "autor").write.parquet(folders["silver.conteudo"])
    interactions = spark.read.parquet(folders["bronze.interacoes"]).drop("autor")
    edges = governance.lineage({"silver.interacao": interactions}, folders)
    interactions.write.parquet(folders["silver.interacao"])
    fact = spark.read.parquet(folders["silver.interacao"]).join(spark.read.parquet(folders["silver.conteudo"]), "conteudo_id").groupBy("autor").count()
    edges = edges.unionByName(governance.lineage({"gold.fato": fact}, folders))
    assert {tuple(r) for r in edges.collect()} == {
        ("bronze.interacoes", "silver.interacao"), ("silver.interacao", "gold.fato"), ("silver.conteudo", "gold.fato")}
    reached = {r["tabela"]: r["distancia"] for r in governance.upstream(edges, "gold.fato").collect()}
    assert reached == {"silver.interacao": 1, "silver.conteudo": 1, "bronze.interacoes": 2}
    tags = {(r["tabela"], r["coluna"]): (r["classificacao"], r["preenchidos"]) for r in governance.classified_columns({"bronze.interacoes": raw}).collect()}
    assert tags == {("interacoes", "usuario_id"): ("IdentificadorIndireto", 1), ("interacoes", "autor"): ("DadoPessoal", 1)}


RAW_CATALOG = """conteudo_id,titulo,tipo,categoria,nivel,carga_horaria_min,data_publicacao,descricao,autor
1,"Dados, parte 1",Curso,Banco de Dados,Básico,30,2024-01-01,"linha 1
linha 2",Ana Lima
2,Nuvem,VIDEO,DevOps & Cloud,basico,abc,2024-01-02,,Bia
x,Errado,Curso,Banco de Dados,Básico,1,2024-01-01,,C
"""
RAW_INTERACTIONS = """[{"usuario_id":1,"conteudo_id":1,"tipo_interacao":"início","data_hora":"2024-01-01T08:00:00","tempo_consumido":12,"percentual_conclusao":10.5},
{"usuario_id":1,"conteudo_id":1,"tipo_interacao":"conclusao","data_hora":"2024-01-02T08:00:00","tempo_consumido":20,"percentual_conclusao":100,"avaliacao_atribuida":5},
{"usuario_id":2,"conteudo_id":9,"tipo_interacao":"curtida","data_hora":"2024-01-02T08:00:00","tempo_consumido":1,"percentual_conclusao":1}]"""
RAW_COMMENTS = '[{"usuario_id":1,"conteudo_id":1,"avaliacao":5,"comentario":"bom","tags":["B","a "],"data":"2024-01-03"}]'


@pytest.fixture
def paths(tmp_path):
    (tmp_path / "inter").mkdir()
    (tmp_path / "coment").mkdir()
    (tmp_path / "catalogo.csv").write_text(RAW_CATALOG)
    (tmp_path / "inter" / "a.json").write_text(RAW_INTERACTIONS)
    (tmp_path / "inter" / "b.json").write_text('[{"usuario_id": 1, "conteudo_id"')
    (tmp_path / "coment" / "a.json").write_text(RAW_COMMENTS)
    return Paths(str(tmp_path / "catalogo.csv"), str(tmp_path / "inter"), str(tmp_path / "coment"), str(tmp_path / "lago"))


def recommendations(spark):
    return spark.createDataFrame([(1, 1, 80.0, 1, "Positivo", DAY)], "usuario_id bigint, conteudo_id bigint, pontuacao double, posicao int, "
                                                                      "classificacao string, gerado_em timestamp_ntz")


def test_whole_run(spark, paths):
    summary = run_medallion(spark, paths, recommendations(spark), "carga-1").collect()
    assert [r["etapa"] for r in summary] == ["bronze", "silver", "qualidade", "gate", "gold", "metadados"]
    assert {r["resultado_final"] for r in summary} == {"sucesso com ressalvas"}
    held = Run(spark, paths, "carga-1").quarantined()
    assert {r["regra_violada"] for r in held.select("regra_violada").collect()} == {
        "ID_INVALIDO", "REFERENCIA_INEXISTENTE", "ARQUIVO_CORROMPIDO"}
    base = paths.layer("gold")
    assert {n: writers.read_current(spark, base, n).count() for n in GOLD_TABLES}["fato_engajamento_dia"] == 2
    overall = writers.read_current(spark, base, "kpi_geral").first()
    assert (overall["usuarios_ativos"], float(overall["taxa_conclusao_pct"]), float(overall["taxa_conversao_recomendacao_pct"])) == (1, 100.0, 100.0)
    comment = spark.read.parquet(paths.layer("silver/comentario")).first()
    assert comment["tags"] == ["a", "b"]
    assert spark.read.parquet(paths.layer("metadados")).count() == 10


def test_tests_take_their_counts_from_the_writes(spark, paths, monkeypatch):
    run = Run(spark, paths, "carga-1")
    run.bronze()
    run.silver()
    tables = run.silver_tables()
    whole = quality.run_tests(*tables, "carga-1")
    monkeypatch.setattr(Run, "silver_tables", lambda self: pytest.fail("Silver was read again"))
    assert run.quality() == "sucesso"
    assert sorted(run.read_results().select(whole.columns).collect()) == sorted(whole.collect())
    assert all("/medidas/" in f for f in quality.measures_of(run.counted()).inputFiles())


def test_gold_follows_batches_without_reading_earlier_ones(spark, paths):
    first = Run(spark, paths, "carga-1")
    first.bronze()
    first.silver()
    batch = first.read("silver/interacao")
    first.gold_increment(batch, recommendations(spark))
    base = paths.layer("gold")
    assert writers.read_current(spark, base, "kpi_geral").first()["usuarios_ativos"] == 1
    more = batch.withColumn("usuario_id", F.col("usuario_id") + 10)
    for _ in range(2):  # a repeated run merges its batch once
        Run(spark, paths, "carga-2").gold_increment(more, recommendations(spark))
    overall = writers.read_current(spark, base, "kpi_geral").first()
    assert (overall["usuarios_ativos"], overall["total_interacoes"], overall["execucao_id"]) == (2, 2 * batch.count(), "carga-2")
    day = writers.read_current(spark, base, "kpi_evolucao_dia")
    assert {r["usuarios_ativos"] for r in day.collect()} == {2}


def test_latest_batch_prunes_folders(spark):
    path = new_folder(spark, "lotes")
    rows = spark.createDataFrame([("a", "2024-01-01", 1), ("b", "2024-01-02", 2), ("b", "2024-01-02", 3)],
                                 "execucao_id string, data_hora_ingestao string, ordem int")
    writers.append_run(rows, path)
    newest = files.latest_batch(spark.read.parquet(path))
    assert sorted(r["ordem"] for r in newest.collect()) == [2, 3]
    assert "(execucao_id#" in newest._jdf.queryExecution().toString().split("PartitionFilters: ")[1]
    assert files.latest_batch(spark.read.parquet(path).where("ordem > 9")).count() == 0


def test_pending_rows_enter_silver_once_their_content_exists(spark, paths):
    run_medallion(spark, paths, recommendations(spark), "carga-1")
    known = spark.read.parquet(paths.layer("silver/conteudo"))
    known.limit(1).withColumn("conteudo_id", F.lit(9).cast("bigint")).write.mode("append").parquet(paths.layer("silver/conteudo"))
    for run_id in ("reproc-1", "reproc-2"):  # the unreadable file keeps waiting
        report = {r["origem"]: (r["reprocessados"], r["ainda_pendentes"]) for r in Run(spark, paths, run_id).reprocess().collect()}
        assert report == {"interacoes": (1, 1)}
    stored = spark.read.parquet(paths.layer("silver/interacao"))
    assert stored.where("conteudo_id = 9").select("usuario_id", "execucao_id").collect() == [(2, "reproc-1")]
    catalog = Run(spark, paths, "x").queue("catalogo")
    assert sorted((r["execucao_id"], r["status"]) for r in catalog.collect()) == [
        ("carga-1", "pendente"), ("reproc-1", "pendente"), ("reproc-2", "pendente")]
    assert catalog.select("id").distinct().count() == 3


def test_a_blocked_gate_leaves_gold_untouched(spark, paths, monkeypatch):
    run_medallion(spark, paths, recommendations(spark), "carga-1")
    passed = quality.measures_of
    monkeypatch.setattr(quality, "measures_of", lambda rows: passed(rows).withColumn("integridade_comentario_conteudo", F.lit(3.0)))
    with pytest.raises(quality.GateBlocked, match="integridade_comentario_conteudo"):
        run_medallion(spark, paths, recommendations(spark), "carga-2")
    assert writers.current_version(spark, paths.layer("gold")) == "carga-1"
    events = spark.read.parquet(paths.layer("auditoria")).where("execucao_id = 'carga-2'")
    assert events.where("etapa = 'gate' and resultado = 'falha'").count() == 1


def test_run_verdict(spark):
    rows = [("r", "a", "inicio", None, DAY), ("r", "a", "fim", "sucesso", DAY + dt.timedelta(seconds=1.5)), ("r", "b", "fim", "falha", DAY)]
    events = spark.createDataFrame(rows, "execucao_id string, etapa string, evento string, resultado string, instante timestamp_ntz")
    made = {r["etapa"]: r for r in audit.stage_summary(events, queue(spark, []), "r").collect()}
    assert made["a"]["duracao_segundos"] == 1.5 and made["b"]["resultado_final"] == "falha"


def test_reprocessing_keeps_entries_and_resumes(spark, tmp_path, monkeypatch):
    (tmp_path / "c.csv").write_text(RAW_CATALOG)
    for name in ("interacoes", "comentarios"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.json").write_text("[]")
    (tmp_path / "interacoes" / "a.json").write_text(
        '[{"usuario_id": 1, "conteudo_id": 9, "tipo_interacao": "início", "data_hora": "2024-01-01T10:00:00", "tempo_consumido": 1, "percentual_conclusao": 5}]')
    paths = Paths(str(tmp_path / "c.csv"), str(tmp_path / "interacoes"), str(tmp_path / "comentarios"), str(tmp_path / "lago"))
    load = Run(spark, paths, "carga-1")
    load.bronze()
    load.silver()
    before = {r["id"]: r["regra_violada"] for r in load.queue("catalogo").collect()}
    assert before
    for run_id in ("carga-1", "reproc-1", "reproc-1"):  # the load's own id, another, and a retry
        Run(spark, paths, run_id).reprocess()
        rows = load.queue("catalogo").collect()
        after = {r["id"]: r["regra_violada"] for r in rows}
        assert len(after) == len(rows) and before.items() <= after.items() and len(after) > len(before)
        before = after
    # the missing content arrives; the attempt breaks off between Silver and the status, and is carried out by the next
    contents = spark.read.parquet(str(tmp_path / "lago/silver/conteudo"))
    contents.limit(1).withColumn("conteudo_id", F.lit(9).cast("bigint")).write.mode("append").parquet(str(tmp_path / "lago/silver/conteudo"))
    broken = Run(spark, paths, "reproc-2")
    monkeypatch.setattr(broken, "_restate", lambda status: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        broken._decide("interacoes", quarantine.reprocess_interactions(
            broken.queue("interacoes"), broken.read("silver/conteudo"), broken.read("silver/interacao"), "reproc-2")[0])
        broken._carry_out()
    assert load.read("silver/interacao").count() == 1 and load.queue("interacoes").where("status = 'pendente'").count() == 1
    Run(spark, paths, "reproc-3").reprocess()
    assert load.read("silver/interacao").count() == 1 and load.queue("interacoes").where("status = 'pendente'").count() == 0


def test_shared_folder_must_be_named_on_a_cluster(spark, monkeypatch):
    from types import SimpleNamespace

    from cascata import session

    fake = SimpleNamespace(sparkContext=SimpleNamespace(master="yarn", getCheckpointDir=lambda: None), conf=SimpleNamespace(get=lambda *_: None))
    with pytest.raises(ValueError):
        session.shared_dir(fake)


def test_no_dimension_is_repeated(spark):
    big = spark.range(1000).select(F.col("id").alias("k"), F.lit("x").alias("nome"))
    plan = lookup(spark.range(10).select(F.col("id").alias("k")), big, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan


def test_pending_payloads_are_parsed_once(spark):
    """Filters on the parsed fields would otherwise be moved below the parser, which then runs once for each of them."""
    payload = '{"usuario_id":"7","conteudo_id":"1","tipo_interacao":"Curtida","data_hora":"2024-01-02","percentual_conclusao":"10"}'
    rows = queue(spark, [entry(1, "a", "interacoes", payload), entry(2, "b", "interacoes", None), entry(3, "c", "interacoes", "{oops"),
                         entry(4, "a", "interacoes", payload.replace('"7"', '"8"')), entry(5, "d", "interacoes", "[]")])
    found = quarantine.pending_interactions(rows)
    fit = found.where(F.col("usuario_id").isNotNull() & F.col("data_hora").isNotNull() & F.col("percentual_conclusao").between(0, 100))
    assert fit._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
    assert [(r["quarentena_id"], r["usuario_id"]) for r in fit.collect()] == [(4, 8)]
    kept = {r["quarentena_id"]: (r["registro_id"], r["_payload"], r["usuario_id"], r["origem"]) for r in found.collect()}
    assert kept == {4: ("a", payload.replace('"7"', '"8"'), 8, None), 2: ("b", None, None, None), 3: ("c", "{oops", None, None), 5: ("d", "[]", None, None)}


def test_former_batches_are_scored_in_whole_numbers(spark, tmp_path):
    """The best of each user and content is found before decimals are made of it."""
    from cascata.sources import driver_tables

    rows = [(i, i % 4, '{"k": %d}' % (i % 9)) for i in range(-40, 160)] + [(7, 1, None), (None, 2, '{"k": 1}')]
    spark.createDataFrame(rows, "event_id long, user_id long, props string").write.parquet(str(tmp_path / "events.parquet"))
    made = driver_tables.recommendations(spark, str(tmp_path))
    aggregate = [line for line in made._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Aggregate" in line]
    assert len(aggregate) == 1 and "max(centesimos" in aggregate[0]
    best = {}
    for event, user, props in rows:
        turn = None if event is None else abs(event) % 2 * (1 if event > 0 else -1)
        content = None if None in (event, props) else int(props[6:-1]) + turn
        score = None if event is None else 41 + (abs(event) * 37 % 5900 * (1 if event > 0 else -1)) / 100
        key = (user, content, turn)
        best[key] = max((s for s in (best.get(key), score) if s is not None), default=None)
    groups = {}
    for (user, content, turn), score in best.items():
        groups.setdefault((user, turn), []).append((-1 if score is None else score, content))
    wanted = sorted((user, str(turn), place, score) for (user, turn), found in groups.items()
                    for place, score in enumerate(sorted((s for s, _ in found), reverse=True)[:5], 1))
    got = [(r["usuario_id"], str(None if r["gerado_em"] is None else (r["gerado_em"] - dt.datetime(2024, 2, 1)).days), r["posicao"],
            -1 if r["pontuacao"] is None else float(r["pontuacao"])) for r in made.collect()]
    assert sorted(got) == [(u, t, p, pytest.approx(s)) for u, t, p, s in wanted]


def test_quarantine_is_written_once_under_its_run(spark, tmp_path):
    """The layer is stored as its sink stores it, so that the entries are not written a second time."""
    for name, columns, rows in (
        ("part", "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int", [(i, f"n {i}", "m", "t", i % 5) for i in range(1, 60)]),
        ("events", "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
         [(i, DAY, i % 7, "view", 1.5, '{"k": %d}' % (i % 60)) for i in range(200)]),
        ("conversations", "conv_id bigint, turn bigint, role string, text string", [(i, 1, "user", "oi") for i in range(20)]),
    ):
        spark.createDataFrame(rows, columns).write.parquet(f"{tmp_path}/{name}.parquet")
    made = registry.QUERIES["sink_quarantine_file"].run(Layers(spark, str(tmp_path)))
    held = Layers(spark, str(tmp_path)).quarantine
    assert all("/quarentena-" in f and "/execucao_id=carga-1/" in f for f in [*made.inputFiles(), *held.inputFiles()])
    assert held.columns == ["id", "registro_id", "origem", "regra_violada", "mensagem", "execucao_id", "payload_original", "status"]
    assert {r[0] for r in held.select("execucao_id").distinct().collect()} == {"carga-1"}
    assert sorted(map(tuple, made.collect()), key=repr) == sorted(map(tuple, held.select(made.columns).collect()), key=repr) and made.count() > 0
