"""Commits, keyed tables and Gold merged from partial sums."""

import datetime as dt
import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import Window, functions as F

from cascata.functions import metrics
from cascata.operators import column_lineage, gold, gold_state, master_data, master_data_runs, privacy
from cascata.session import new_folder
from cascata.sources import keyed, versions, writers

DAY = dt.datetime(2024, 1, 1)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_of_two_runs_from_one_version_one_commits(spark):
    base = new_folder(spark, "tabelas")
    writers.publish_version({"t": spark.range(1)}, base, "a")
    start = versions.newest(spark, base)
    writers.publish_version({"t": spark.range(2)}, base, "b", start)
    with pytest.raises(versions.CommitConflict, match="c read 0"):
        writers.publish_version({"t": spark.range(3)}, base, "c", start)
    assert writers.current_version(spark, base) == "b" and writers.read_current(spark, base, "t").count() == 2
    assert writers.read_current(spark, base, "t", start).count() == 1  # a reader keeps its version


def test_many_writers_at_once_leave_one_commit_per_number(spark):
    base = new_folder(spark, "tabelas")

    def attempt(i):
        try:
            return versions.commit(spark, base, versions.NOTHING, f"r{i}", {}).run_id
        except versions.CommitConflict:
            return None

    with ThreadPoolExecutor(8) as pool:
        won = [r for r in pool.map(attempt, range(16)) if r]
    assert len(won) == 1 and writers.current_version(spark, base) == won[0]


def test_tables_that_a_commit_does_not_change_stay(spark):
    base = new_folder(spark, "tabelas")
    first = versions.publish(spark, base, {"a": spark.range(1), "b": spark.range(2)}, "1")
    second = versions.publish(spark, base, {"b": spark.range(5)}, "2")
    assert second.tables["a"] == first.tables["a"] and versions.read(spark, base, second, "b").count() == 5
    assert versions.expire(spark, base, keep=2) == []
    gone = versions.expire(spark, base, keep=1)
    assert gone == [first.tables["b"].parts[versions.WHOLE][0]] and versions.read(spark, base, second, "a").count() == 1


def people(spark, rows):
    return spark.createDataFrame(rows, "id long, nome string, notas array<float>")


def test_an_upsert_writes_only_the_buckets_it_touches(spark):
    base = new_folder(spark, "pessoas")
    keyed.create(people(spark, [(i, "velho", [0.5 * i]) for i in range(200)]), base, "p", ["id"], "v1")
    before = versions.newest(spark, base).tables["p"].parts

    def files(folder):
        return sorted((n, os.stat(os.path.join(folder, n)).st_mtime_ns) for n in os.listdir(folder))

    listed = {p: files(f"{base}/dados/{folders[0]}") for p, folders in before.items()}
    updates = people(spark, [(7, "novo", [1.0, 2.0]), (500, "mais", None)])
    keyed.upsert(spark, base, "p", updates, "v2")
    after = versions.newest(spark, base).tables["p"].parts
    touched = {p for p in after if len(after[p]) > len(before.get(p, []))}
    assert 1 <= len(touched) <= 2 and all(after[p] == before[p] for p in after if p not in touched)
    assert {p: files(f"{base}/dados/{folders[0]}") for p, folders in before.items()} == listed
    expected = [(i, "velho", [0.5 * i]) for i in range(200) if i != 7] + [(7, "novo", [1.0, 2.0]), (500, "mais", None)]
    assert rows_of(keyed.read(spark, base, "p")) == sorted(expected, key=repr)


def test_the_newest_row_of_a_key_wins_until_and_after_compaction(spark):
    base = new_folder(spark, "pessoas")
    keyed.create(people(spark, [(1, "a", None), (None, "sem", None)]), base, "p", ["id"], "v0", buckets=2)
    for n in range(1, 7):
        keyed.upsert(spark, base, "p", people(spark, [(1, f"a{n}", [float(n)]), (n + 10, "x", None), (None, f"sem{n}", None)]), f"v{n}")
    read = versions.newest(spark, base)
    wanted = sorted([(1, "a6", [6.0]), (None, "sem6", None), *[(n + 10, "x", None) for n in range(1, 7)]], key=repr)
    assert rows_of(keyed.read(spark, base, "p")) == wanted
    compacted = keyed.compact(spark, base, "p", "compacta", most=2)
    assert all(len(f) <= 2 for f in compacted.tables["p"].parts.values())
    assert rows_of(keyed.read(spark, base, "p")) == wanted == rows_of(keyed.read(spark, base, "p", read))
    keyed.upsert(spark, base, "p", people(spark, [(1, "fim", None)]), "v7")
    assert keyed.read(spark, base, "p").where("id = 1").first()["nome"] == "fim"


def test_insert_absent_keeps_the_first_value_and_a_replay_changes_nothing(spark):
    base = new_folder(spark, "pessoas")
    keyed.create(people(spark, [(1, "a", None)]), base, "p", ["id"], "v1")
    given = spark.createDataFrame([(1, "b"), (2, "b")], "id int, nome string").withColumn("notas", F.lit(None).cast("array<float>"))
    keyed.insert_absent(spark, base, "p", given, "v2")
    number = versions.newest(spark, base).number
    keyed.insert_absent(spark, base, "p", given, "v2")
    assert versions.newest(spark, base).number == number
    assert {r["id"]: r["nome"] for r in keyed.read(spark, base, "p").collect()} == {1: "a", 2: "b"}


CONTENT = "conteudo_id long, titulo string, tipo string, categoria string, nivel string, carga_horaria_min long, data_publicacao date, autor string, origem string, arquivo_origem string, data_hora_ingestao string, execucao_id string"
INTERACTION = "usuario_id long, conteudo_id long, tipo_interacao string, data_hora timestamp_ntz, tempo_consumido long, percentual_conclusao decimal(5,2), avaliacao_atribuida long"


@pytest.fixture(scope="module")
def silver_tables(spark):
    kinds = ["visualização", "início", "conclusão", "curtida", "avaliação"]
    contents = spark.createDataFrame(
        [(i, f"t{i}", "Curso" if i % 2 else "Artigo", f"c{i % 3}", "Básico", None if i == 4 else 10 * i, DAY.date(), "a", "o", "f", "h", "e") for i in range(8)], CONTENT)
    interactions = spark.createDataFrame(
        [(i * 7 % 11, i * 5 % 7, kinds[i * 3 % 5], DAY + dt.timedelta(hours=i * 3), None if i % 9 == 0 else i, None, i % 5 + 1 if i % 4 == 0 else None)
         for i in range(120)], INTERACTION)
    batch = spark.createDataFrame([(u, c, 80.0, 1, "Positivo", DAY) for u in range(6) for c in range(4)],
                                  "usuario_id long, conteudo_id long, pontuacao double, posicao int, classificacao string, gerado_em timestamp_ntz")
    return contents, interactions.cache(), batch


def rebuilt(contents, interactions, batch, run):
    conversion = gold.kpi_rec_conversion(batch, interactions, run)
    return {
        "dim_conteudo": gold.dim_content(contents, run), "fato_engajamento_dia": gold.fact_engagement_day(interactions, run),
        "kpi_desempenho_categoria": gold.kpi_category(contents, interactions, run), "kpi_engajamento_formato": gold.kpi_format(contents, interactions, run),
        "kpi_evolucao_dia": gold.kpi_day(interactions, run), "kpi_conversao_recomendacao": conversion,
        "kpi_geral": gold.kpi_overall(contents, interactions, conversion, run),
    }


def test_two_loads_that_share_days_equal_a_full_rebuild(spark, silver_tables):
    contents, interactions, batch = silver_tables
    base = new_folder(spark, "estado")
    first = gold_state.merge(spark, base, interactions.where("tempo_consumido is null or tempo_consumido < 70"), "carga-1")
    second = gold_state.merge(spark, base, interactions.where("tempo_consumido >= 70"), "carga-2")
    untouched = [p for p, f in second.tables["estado"].parts.items() if p in first.tables["estado"].parts and f == first.tables["estado"].parts[p]]
    assert any(p.startswith("conteudo_dia") for p in untouched) and any(p.startswith("usuario_dia") for p in untouched)
    assert gold_state.merge(spark, base, interactions.where("tempo_consumido >= 70"), "carga-2") == second  # a repeated load
    made, wanted = gold_state.tables(spark, base, second, contents, batch, "r"), rebuilt(contents, interactions, batch, "r")
    assert list(made) == list(wanted)
    for name in wanted:
        assert rows_of(made[name]) == rows_of(wanted[name].select(made[name].columns)), name


def test_a_load_writes_its_own_sums_beside_the_stored_ones(spark, silver_tables):
    contents, interactions, batch = silver_tables
    base, loads = new_folder(spark, "estado"), gold_state.MOST_LOADS + 2
    timed = interactions.where("tempo_consumido is not null")
    timed = timed.unionByName(timed.withColumn("tempo_consumido", F.col("tempo_consumido") + 1))  # every key is in two loads
    states = [gold_state.merge(spark, base, timed.where(F.pmod("tempo_consumido", F.lit(loads)) == i), f"carga-{i}").tables["estado"].parts
              for i in range(loads)]
    shared = [p for p in states[1] if p in states[0] and len(states[1][p]) > 1]
    assert {p.split("-")[0] for p in shared} == {gold_state.CONTENT_DAY, gold_state.USER_DAY, gold_state.PAIR}
    assert all(states[1][p][:1] == states[0][p] for p in states[0])  # what was stored is neither read nor written again
    assert max(len(folders) for parts in states for folders in parts.values()) == gold_state.MOST_LOADS  # crowded parts are added up
    version = versions.newest(spark, base)
    made, wanted = gold_state.tables(spark, base, version, contents, batch, "r"), rebuilt(contents, timed, batch, "r")
    for name in wanted:
        assert rows_of(made[name]) == rows_of(wanted[name].select(made[name].columns)), name
    for grain in (gold_state.CONTENT_DAY, gold_state.USER_DAY, gold_state.PAIR):
        once, written = (f(spark, base, version, grain) for f in (gold_state.read, gold_state.read_loads))
        assert once.count() == once.select(*gold_state.KEYS).distinct().count() < written.count()


def test_gold_from_sums_reads_no_interactions(spark, silver_tables):
    contents, interactions, batch = silver_tables
    base, silver = new_folder(spark, "estado"), new_folder(spark, "silver")
    interactions.write.parquet(silver)
    version = gold_state.merge(spark, base, spark.read.parquet(silver), "carga-1")
    for rows in gold_state.tables(spark, base, version, contents, batch, "r").values():
        assert silver not in "".join(rows.inputFiles()) and "tipo_interacao" not in rows._jdf.queryExecution().optimizedPlan().toString()


def test_partial_sums_scan_a_batch_once(spark, silver_tables):
    path = new_folder(spark, "silver")
    silver_tables[1].write.parquet(path)
    plan = gold_state.partial_sums(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("hashpartitioning") == 1


def test_no_interactions_give_empty_sums(spark, silver_tables):
    contents, interactions, batch = silver_tables
    base = new_folder(spark, "estado")
    version = gold_state.merge(spark, base, interactions.limit(0), "vazia")
    made = gold_state.tables(spark, base, version, contents, batch, "r")
    assert made["fato_engajamento_dia"].count() == 0 and made["kpi_desempenho_categoria"].agg(F.sum("qtd_conteudos")).first()[0] == 8
    assert made["kpi_geral"].first()["usuarios_ativos"] == 0 and set(metrics.COUNT_NAMES) <= set(gold_state.SUMS)


def test_pseudonyms_stay_whatever_runs_overlap(spark):
    base = new_folder(spark, "pseudonimos")
    users = lambda a, b: spark.range(a, b).withColumnRenamed("id", "usuario_id")
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(lambda ab: privacy.keep_pseudonyms(spark, base, users(*ab), f"r{ab[0]}"), [(0, 60), (30, 90), (10, 40)]))
    first = {r["usuario_id"]: r["pseudo_id"] for r in privacy.kept_pseudonyms(spark, base).collect()}
    assert sorted(first) == list(range(90)) and len(set(first.values())) == 90
    number = versions.newest(spark, base).number
    privacy.keep_pseudonyms(spark, base, users(20, 80), "de novo")
    assert versions.newest(spark, base).number == number
    privacy.keep_pseudonyms(spark, base, users(80, 100), "mais")
    after = {r["usuario_id"]: r["pseudo_id"] for r in privacy.kept_pseudonyms(spark, base).collect()}
    assert first.items() <= after.items() and len(after) == 100


RECORDS = [(1, "Dados", "Curso", "A"), (2, "dados ", "Curso", "a"), (3, "Nuvem", "Curso", "B"), (5, "Redes", "Artigo", "C")]


def catalogue(spark, rows):
    full = [(i, t, k, "Cat", f"nivel{i}", None if i % 2 else i, dt.date(2024, 1, 1) + dt.timedelta(days=i), a) for i, t, k, a in rows]
    return spark.createDataFrame(full, master_data_runs.RECORD)


def test_runs_of_master_data_equal_one_full_run(spark):
    base = new_folder(spark, "mestres")
    master_data_runs.run(spark, base, catalogue(spark, RECORDS), "2024-01-01", "r1")
    more = [(7, "DADOS", "Curso", "A"), (8, "Nova", "Curso", "D"), (3, "Redes", "Artigo", "C")]  # 3 was corrected and joins 5
    master_data_runs.run(spark, base, catalogue(spark, more), "2024-02-01", "r2")
    final = catalogue(spark, [r for r in RECORDS if r[0] != 3] + more)
    full = {r["mestre_id"]: r for r in master_data.master(final).collect()}
    made = {r["mestre_id"]: r for r in master_data_runs.master(spark, base).collect()}
    # the group of 5 keeps its name when 3 joins it; a full run would name it after 3
    assert made.pop("CNT-00005").asDict() == full.pop("CNT-00003").asDict() | {"mestre_id": "CNT-00005"}
    assert made == full
    assert {r["conteudo_id"]: r["mestre_id"] for r in master_data_runs.crosswalk(spark, base).collect()} == {
        1: "CNT-00001", 2: "CNT-00001", 7: "CNT-00001", 8: "CNT-00008", 3: "CNT-00005", 5: "CNT-00005"}
    assert {r["conteudo_id"]: r["mestre_id"] for r in master_data_runs.crosswalk(spark, base, at="2024-01-15").collect()} == {
        1: "CNT-00001", 2: "CNT-00001", 3: "CNT-00003", 5: "CNT-00005"}
    number = versions.newest(spark, base).number
    again = master_data_runs.run(spark, base, catalogue(spark, more), "2024-03-01", "r2")
    assert again.number == number + 1 and not master_data_runs.crosswalk(spark, base, at="2024-03-02").exceptAll(master_data_runs.crosswalk(spark, base)).count()
    assert keyed.read(spark, base, "de_para").where("valido_de = '2024-03-01'").count() == 0


def test_a_run_reads_the_members_of_touched_groups_only(spark, monkeypatch):
    base = new_folder(spark, "mestres")
    master_data_runs.run(spark, base, catalogue(spark, [(i, f"t{i}", "Curso", "A") for i in range(100)]), "2024-01-01", "r1")
    asked = []
    reading = keyed.read
    monkeypatch.setattr(keyed, "read", lambda spark, base, name, version=None, parts=None: asked.append((name, parts)) or reading(spark, base, name, version, parts))
    before = versions.newest(spark, base)
    after = master_data_runs.run(spark, base, catalogue(spark, [(200, "T7", "Curso", "a")]), "2024-02-01", "r2")
    assert all(parts is not None and len(parts) <= 2 for _, parts in asked) and {n for n, _ in asked} == set(master_data_runs.TABLES)
    assert sum(before.tables["mestres"].parts[p] != after.tables["mestres"].parts[p] for p in before.tables["mestres"].parts) == 1


def test_lineage_follows_unions_windows_generators_and_circles(spark):
    base = new_folder(spark, "tabelas")
    a, b = f"{base}/a", f"{base}/b"
    spark.createDataFrame([(1, "x", ["p", "q"])], "k int, v string, l array<string>").write.parquet(a)
    spark.createDataFrame([(1, 2.0)], "k int, w double").write.parquet(b)
    left, right = spark.read.parquet(a), spark.read.parquet(b)
    joined = left.join(right, "k").select("k", (F.col("w") + F.length("v")).alias("soma"), F.explode("l").alias("item"))
    united = joined.select("k", F.col("soma").cast("string").alias("t")).union(left.select("k", "v"))
    ranked = united.withColumn("pos", F.row_number().over(Window.partitionBy("k").orderBy("t")))
    found = column_lineage.sources(ranked, {"a": a, "b": b})
    assert found == {"k": {("a", "k")}, "t": {("a", "v"), ("b", "w")}, "pos": {("a", "k"), ("a", "v"), ("b", "w")}}
    assert column_lineage.sources(joined, {"a": a})["item"] == {("a", "l")}
    summed = left.groupingSets([[F.col("k")], [F.col("v")]], "k", "v").agg(F.count("l").alias("n"))
    assert column_lineage.sources(summed, {"a": a})["n"] == {("a", "l")}
    opaque = left.select("k", "v").mapInArrow(lambda it: it, "k int, v string")
    assert column_lineage.sources(opaque, {"a": a})["k"] == {("a", "k"), ("a", "v")}
    steps = [("t1", "c", "t2", "c"), ("t2", "c", "t3", "c"), ("t3", "c", "t1", "c"), ("t3", "c", "t4", "d"), ("t4", "d", "t5", "d"), ("t5", "d", "t6", "d"), ("t6", "d", "t7", "d")]
    reached = {(r[0], r[2]): r[4] for r in column_lineage.closure(spark.createDataFrame(steps, column_lineage.EDGE)).collect()}
    assert reached[("t1", "t7")] == 6 and reached[("t1", "t1")] == 3 and ("t7", "t1") not in reached
