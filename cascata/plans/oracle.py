"""The same results in plain SQL over the given tables, for checking the Spark queries."""

from __future__ import annotations

import re

from cascata.schemas import CATEGORIES

CATEGORY_LIST = "[" + ", ".join(f"'{c}'" for c in CATEGORIES) + "]"
DAY = "'%Y-%m-%d'"
INSTANT = "'%Y-%m-%d %H:%M:%S'"


def ratio(num: str, den: str, places: int, factor: int = 1) -> str:
    """Quotient of whole numbers rounded half up, computed on whole numbers."""
    scale = 10**places
    return f"CAST((({num}) * {2 * factor * scale} + ({den})) // (2 * NULLIF(({den}), 0)) AS DOUBLE) / {scale}"


def pct(num: str, den: str) -> str:
    return ratio(num, den, 2, 100)


def label(column: str, domain: dict[str, str]) -> str:
    whens = " ".join(f"WHEN '{plain}' THEN '{official}'" for plain, official in domain.items())
    return f"CASE lower(strip_accents({column})) {whens} ELSE {column} END"


def plain(domain: list[str]) -> dict[str, str]:
    table = str.maketrans("áâãçéêíóôõú", "aaaceeiooou")
    return {d.lower().translate(table): d for d in domain}


TYPES = plain(["Artigo", "Curso", "Podcast", "Vídeo"])
KINDS = plain(["avaliação", "compartilhamento", "conclusão", "curtida", "início", "visualização"])
LEVELS = plain(["Básico", "Intermediário", "Avançado"])
LABELS = plain(CATEGORIES)


def among(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def canonical(column: str, domain: list[str]) -> str:
    whens = " ".join(f"WHEN '{d.lower()}' THEN '{d}'" for d in domain)
    return f"CASE lower(trim({column})) {whens} ELSE NULLIF(trim({column}), '') END"


AUDIT = "'2024-02-01T00:00:00' AS data_hora_ingestao, 'carga-1' AS execucao_id"
EVENT_CONTENT = "(CAST(json_extract_string(props, '$.k') AS BIGINT) + 100 * (user_id // 15))"
CONCLUDED = "(tipo_interacao = 'conclusão' OR percentual_conclusao >= 100)"
STARTED = "tipo_interacao IN ('início', 'visualização')"
STARTED_I = "i.tipo_interacao IN ('início', 'visualização')"
CONCLUDED_I = "(i.tipo_interacao = 'conclusão' OR i.percentual_conclusao >= 100)"
CATALOG = ["conteudo_id", "titulo", "tipo", "categoria", "nivel", "carga_horaria_min", "data_publicacao", "descricao", "autor"]
INTERACTION = ["usuario_id", "conteudo_id", "tipo_interacao", "data_hora", "tempo_consumido", "percentual_conclusao", "avaliacao_atribuida"]
COMMENT = ["usuario_id", "conteudo_id", "avaliacao", "comentario", "tags", "data"]
TRAIL = ["origem", "arquivo_origem", "data_hora_ingestao", "execucao_id"]


def payload(columns: list[str]) -> str:
    return "CAST(to_json({" + ", ".join(f"'{c}': {c}" for c in columns + TRAIL) + "}) AS VARCHAR)"


def normal_tags(column: str) -> str:
    """Lower-case, trimmed, distinct, sorted tags of a JSON list; other text gives an empty list."""
    return (
        f"coalesce(list_sort(list_distinct(list_filter(list_transform(TRY_CAST(TRY_CAST({column} AS JSON) AS VARCHAR[]), "
        "lambda t: lower(trim(t))), lambda t: t <> ''))), CAST([] AS VARCHAR[]))"
    )


DECIMAL_TEXT = r"'^-?\d+(\.\d+)?$'"


def rounded(column: str, places: int) -> str:
    value = f"NULLIF(trim({column}), '')"
    return f"CASE WHEN regexp_matches({value}, {DECIMAL_TEXT}) THEN round(TRY_CAST({value} AS DECIMAL(28,8)), {places}) END"


CTES: dict[str, str] = {
    "bronze_catalogo": f"""
        SELECT p_partkey * 2 + copia AS ordem,
          CASE WHEN p_partkey % 43 = 42 THEN 'x' ELSE CAST(p_partkey AS VARCHAR) END AS conteudo_id,
          CASE WHEN p_partkey % 53 = 52 THEN '  ' WHEN p_partkey % 7 = 0 THEN upper(p_name)
               WHEN p_partkey % 11 = 0 THEN replace(p_name, ' ', '  ') ELSE p_name END AS titulo,
          CASE WHEN p_partkey % 29 = 28 THEN 'Workshop' WHEN p_partkey % 4 = 0 THEN 'Artigo' WHEN p_partkey % 4 = 1 THEN 'curso '
               WHEN p_partkey % 4 = 2 THEN 'VIDEO' ELSE 'Podcast' END AS tipo,
          CASE WHEN p_partkey % 31 = 30 THEN 'Culinária' WHEN p_partkey % 3 = 0 THEN upper({CATEGORY_LIST}[p_partkey % 8 + 1])
               ELSE {CATEGORY_LIST}[p_partkey % 8 + 1] END AS categoria,
          CASE WHEN p_partkey % 37 = 36 THEN 'Mestre' WHEN p_size % 3 = 0 THEN 'Básico' WHEN p_size % 3 = 1 THEN 'intermediario'
               ELSE 'AVANÇADO' END AS nivel,
          CASE WHEN p_partkey % 17 = 0 THEN 'abc' WHEN p_partkey % 41 = 40 THEN '-5'
               WHEN p_partkey % 47 = 46 THEN CAST(p_size AS VARCHAR) || '.5' ELSE CAST(p_size AS VARCHAR) END AS carga_horaria_min,
          CASE WHEN p_partkey % 23 = 22 THEN NULL WHEN p_partkey % 61 = 60 THEN '2024-02-30'
               ELSE strftime(DATE '2024-01-01' + CAST(p_partkey % 365 AS INTEGER), {DAY}) END AS data_publicacao,
          p_type AS descricao,
          CASE WHEN p_partkey % 71 = 70 THEN NULL ELSE p_brand || ' ' || p_type END AS autor,
          'catalogo' AS origem, 'catalogo.csv' AS arquivo_origem, {AUDIT}
        FROM (SELECT *, unnest(range(0, CASE WHEN p_partkey % 20 = 0 THEN 2 ELSE 1 END)) AS copia FROM part)""",
    "bronze_interacoes": f"""
        SELECT event_id AS ordem, CAST(user_id AS VARCHAR) AS usuario_id,
          CASE WHEN event_id % 101 = 100 THEN 'abc' ELSE CAST({EVENT_CONTENT} AS VARCHAR) END AS conteudo_id,
          CASE event_type WHEN 'view' THEN 'Visualizacao' WHEN 'click' THEN 'início' WHEN 'purchase' THEN 'conclusão'
               WHEN 'signup' THEN 'curtida ' ELSE event_type END AS tipo_interacao,
          CASE WHEN event_id % 97 = 0 THEN '2024-02-30' WHEN event_id % 89 = 0 THEN strftime(ts, '%Y-%m-%d 00:00:00')
               WHEN event_id % 4 = 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') ELSE strftime(ts, '%Y-%m-%dT00:00:00') END AS data_hora,
          CASE WHEN event_id % 59 = 0 THEN NULL WHEN event_id % 41 = 0 THEN '-' || CAST(CAST(floor(value) AS BIGINT) AS VARCHAR)
               ELSE CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END AS tempo_consumido,
          CASE WHEN event_id % 10 = 3 THEN CAST(event_id % 106 AS VARCHAR) || '.555' ELSE CAST(event_id % 106 AS VARCHAR) END
            AS percentual_conclusao,
          CASE WHEN event_id % 3 = 0 THEN CAST(event_id % 7 AS VARCHAR) END AS avaliacao_atribuida,
          'interacoes' AS origem, 'interacoes.json' AS arquivo_origem, {AUDIT}
        FROM events""",
    "bronze_comentarios": f"""
        SELECT conv_id * 100 + turn AS ordem, CAST(conv_id AS VARCHAR) AS usuario_id, CAST(conv_id * 7 AS VARCHAR) AS conteudo_id,
          CASE WHEN conv_id % 17 = 16 THEN 'otimo' ELSE CAST(1 + (conv_id + turn) % 6 AS VARCHAR) END AS avaliacao,
          text AS comentario,
          CASE WHEN conv_id % 13 = 0 THEN 'oops'
               ELSE '["' || role || '"," ' || upper(role) || ' ","tag' || CAST(turn % 3 AS VARCHAR) || '"]' END AS tags,
          CASE WHEN (conv_id + turn) % 19 = 0 THEN 'ontem'
               ELSE strftime(DATE '2024-01-01' + CAST((conv_id + turn // 2) % 30 AS INTEGER), {DAY}) END AS data,
          'comentarios' AS origem, 'comentarios.json' AS arquivo_origem, {AUDIT}
        FROM conversations""",
    "tipado_conteudo": f"""
        SELECT ordem, conteudo_id AS id_bruto, origem, arquivo_origem, data_hora_ingestao, execucao_id,
          {payload(CATALOG)} AS payload_original,
          CASE WHEN regexp_matches(trim(conteudo_id), '^\\d+$') THEN TRY_CAST(trim(conteudo_id) AS BIGINT) END AS conteudo_id,
          NULLIF(trim(titulo), '') AS titulo, {label("NULLIF(trim(tipo), '')", TYPES)} AS tipo,
          {label("NULLIF(trim(categoria), '')", LABELS)} AS categoria, {label("NULLIF(trim(nivel), '')", LEVELS)} AS nivel,
          CASE WHEN {rounded('carga_horaria_min', 0)} >= 0 THEN CAST({rounded('carga_horaria_min', 0)} AS BIGINT) END AS carga_horaria_min,
          TRY_CAST(data_publicacao AS DATE) AS data_publicacao, NULLIF(trim(descricao), '') AS descricao, NULLIF(trim(autor), '') AS autor
        FROM bronze_catalogo""",
    "julgado_conteudo": f"""
        SELECT *, 'catalogo:conteudo_id=' || coalesce(id_bruto, 'NULL') AS registro_id,
          CASE WHEN conteudo_id IS NULL THEN 'ID_INVALIDO' WHEN vez > 1 THEN 'DUPLICADO'
               WHEN tipo IS NULL OR tipo NOT IN {among(TYPES.values())} THEN 'TIPO_FORA_DO_DOMINIO'
               WHEN categoria IS NULL OR categoria NOT IN {among(CATEGORIES)} THEN 'CATEGORIA_FORA_DO_DOMINIO'
               WHEN nivel IS NULL OR nivel NOT IN {among(LEVELS.values())} THEN 'NIVEL_FORA_DO_DOMINIO' END AS regra_violada
        FROM (SELECT *, row_number() OVER (PARTITION BY conteudo_id ORDER BY ordem) AS vez FROM tipado_conteudo)""",
    "silver_conteudo": "SELECT * FROM julgado_conteudo WHERE regra_violada IS NULL",
    "tipado_interacao": f"""
        SELECT ordem, usuario_id AS usuario_bruto, conteudo_id AS conteudo_bruto, NULLIF(trim(data_hora), '') AS data_bruta,
          origem, arquivo_origem, data_hora_ingestao, execucao_id, {payload(INTERACTION)} AS payload_original,
          CASE WHEN regexp_matches(trim(usuario_id), '^\\d+$') AND CAST(trim(usuario_id) AS BIGINT) > 0
               THEN CAST(trim(usuario_id) AS BIGINT) END AS usuario_id,
          CASE WHEN regexp_matches(trim(conteudo_id), '^\\d+$') THEN TRY_CAST(trim(conteudo_id) AS BIGINT) END AS conteudo_id,
          {label("NULLIF(trim(tipo_interacao), '')", KINDS)} AS tipo_interacao,
          TRY_CAST(data_hora AS TIMESTAMP) AS data_hora,
          CASE WHEN {rounded('tempo_consumido', 0)} >= 0 THEN CAST({rounded('tempo_consumido', 0)} AS BIGINT) END AS tempo_consumido,
          {rounded('percentual_conclusao', 2)} AS percentual_conclusao,
          CAST({rounded('avaliacao_atribuida', 0)} AS BIGINT) AS avaliacao_atribuida
        FROM bronze_interacoes""",
    "julgado_interacao": f"""
        SELECT *, 'interacoes:usuario_id=' || coalesce(usuario_bruto, 'NULL') || ',conteudo_id=' || coalesce(conteudo_bruto, 'NULL')
             || ',data_hora=' || coalesce(data_bruta, 'NULL') AS registro_id,
          CASE WHEN usuario_id IS NULL THEN 'USUARIO_INVALIDO' WHEN conteudo_id IS NULL OR existe IS NULL THEN 'REFERENCIA_INEXISTENTE'
               WHEN vez > 1 THEN 'DUPLICADO'
               WHEN tipo_interacao IS NULL OR tipo_interacao NOT IN {among(KINDS.values())} THEN 'TIPO_INTERACAO_FORA_DO_DOMINIO'
               WHEN data_hora IS NULL THEN 'DATA_INVALIDA'
               WHEN percentual_conclusao IS NULL OR percentual_conclusao < 0 OR percentual_conclusao > 100 THEN 'PERCENTUAL_FORA_DA_FAIXA'
               WHEN avaliacao_atribuida < 1 OR avaliacao_atribuida > 5 THEN 'AVALIACAO_FORA_DA_FAIXA' END AS regra_violada
        FROM (SELECT t.*, c.conteudo_id AS existe,
                row_number() OVER (PARTITION BY t.usuario_id, t.conteudo_id, t.data_hora ORDER BY t.ordem) AS vez
              FROM tipado_interacao t LEFT JOIN silver_conteudo c ON c.conteudo_id = t.conteudo_id)""",
    "silver_interacao": "SELECT * FROM julgado_interacao WHERE regra_violada IS NULL",
    "tipado_comentario": f"""
        SELECT ordem, usuario_id AS usuario_bruto, conteudo_id AS conteudo_bruto, NULLIF(trim(data), '') AS data_bruta,
          NULLIF(trim(avaliacao), '') AS nota_bruta, origem, arquivo_origem, data_hora_ingestao, execucao_id,
          {payload(COMMENT)} AS payload_original,
          CASE WHEN CAST(usuario_id AS BIGINT) > 0 THEN CAST(usuario_id AS BIGINT) END AS usuario_id,
          CAST(conteudo_id AS BIGINT) AS conteudo_id, CAST({rounded('avaliacao', 0)} AS BIGINT) AS avaliacao,
          NULLIF(trim(comentario), '') AS comentario, {normal_tags('tags')} AS tags,
          TRY_CAST(data AS DATE) AS data
        FROM bronze_comentarios""",
    "julgado_comentario": """
        SELECT *, 'comentarios:usuario_id=' || coalesce(usuario_bruto, 'NULL') || ',conteudo_id=' || coalesce(conteudo_bruto, 'NULL')
             || ',data=' || coalesce(data_bruta, 'NULL') AS registro_id,
          CASE WHEN usuario_id IS NULL THEN 'USUARIO_INVALIDO' WHEN conteudo_id IS NULL OR existe IS NULL THEN 'REFERENCIA_INEXISTENTE'
               WHEN vez > 1 THEN 'DUPLICADO' WHEN data IS NULL THEN 'DATA_INVALIDA'
               WHEN nota_bruta IS NOT NULL AND (avaliacao IS NULL OR avaliacao < 1 OR avaliacao > 5) THEN 'AVALIACAO_FORA_DA_FAIXA'
          END AS regra_violada
        FROM (SELECT t.*, c.conteudo_id AS existe,
                row_number() OVER (PARTITION BY t.usuario_id, t.conteudo_id, t.data ORDER BY t.ordem) AS vez
              FROM tipado_comentario t LEFT JOIN silver_conteudo c ON c.conteudo_id = t.conteudo_id)""",
    "silver_comentario": "SELECT * FROM julgado_comentario WHERE regra_violada IS NULL",
    "rejeitados": """
        SELECT ordem AS id, registro_id, 'catalogo' AS origem, regra_violada, payload_original FROM julgado_conteudo WHERE regra_violada IS NOT NULL
        UNION ALL SELECT ordem, registro_id, 'interacoes', regra_violada, payload_original FROM julgado_interacao WHERE regra_violada IS NOT NULL
        UNION ALL SELECT ordem, registro_id, 'comentarios', regra_violada, payload_original FROM julgado_comentario WHERE regra_violada IS NOT NULL""",
    "limpo_catalogo": f"""
        SELECT ordem, conteudo_id, titulo, tipo, categoria, nivel, carga, dia AS data_publicacao, descricao, autor, mudou, vez
        FROM (SELECT ordem, conteudo_id, NULLIF(trim(titulo), '') AS titulo, {canonical('tipo', list(TYPES.values()))} AS tipo,
                {canonical('categoria', CATEGORIES)} AS categoria, {canonical('nivel', list(LEVELS.values()))} AS nivel,
                CASE WHEN TRY_CAST(carga_horaria_min AS DOUBLE) = floor(TRY_CAST(carga_horaria_min AS DOUBLE))
                     THEN TRY_CAST(carga_horaria_min AS BIGINT) END AS carga,
                TRY_CAST(data_publicacao AS DATE) AS dia, descricao, autor,
                (NULLIF(trim(titulo), '') IS DISTINCT FROM trim(titulo))
                OR ({canonical('tipo', list(TYPES.values()))} IS DISTINCT FROM trim(tipo))
                OR ({canonical('categoria', CATEGORIES)} IS DISTINCT FROM trim(categoria))
                OR ({canonical('nivel', list(LEVELS.values()))} IS DISTINCT FROM trim(nivel))
                OR (CASE WHEN TRY_CAST(carga_horaria_min AS DOUBLE) = floor(TRY_CAST(carga_horaria_min AS DOUBLE))
                         THEN CAST(TRY_CAST(carga_horaria_min AS BIGINT) AS VARCHAR) END IS DISTINCT FROM carga_horaria_min)
                OR (strftime(TRY_CAST(data_publicacao AS DATE), {DAY}) IS DISTINCT FROM data_publicacao) AS mudou,
                row_number() OVER (PARTITION BY conteudo_id ORDER BY ordem) AS vez
              FROM bronze_catalogo)""",
    "limpo_interacoes": f"""
        SELECT *, row_number() OVER (PARTITION BY usuario_id, conteudo_id, data_hora ORDER BY ordem) AS vez
        FROM (SELECT ordem, usuario_id, conteudo_id, {canonical('tipo_interacao', list(KINDS.values()))} AS tipo_interacao,
                strftime(TRY_CAST(data_hora AS TIMESTAMP), '%Y-%m-%dT%H:%M:%S') AS data_hora,
                CAST(tempo_consumido AS BIGINT) AS tempo_consumido,
                round(CAST(percentual_conclusao AS DECIMAL(28,8)), 2) AS percentual_conclusao,
                CAST(avaliacao_atribuida AS BIGINT) AS avaliacao_atribuida,
                ({canonical('tipo_interacao', list(KINDS.values()))} IS DISTINCT FROM trim(tipo_interacao))
                OR (strftime(TRY_CAST(data_hora AS TIMESTAMP), '%Y-%m-%dT%H:%M:%S') IS DISTINCT FROM data_hora)
                OR (round(CAST(percentual_conclusao AS DECIMAL(28,8)), 2) <> CAST(percentual_conclusao AS DECIMAL(28,8)))
                OR (CAST(CAST(tempo_consumido AS BIGINT) AS VARCHAR) IS DISTINCT FROM tempo_consumido) AS mudou
              FROM bronze_interacoes)""",
    "limpo_comentarios": f"""
        SELECT *, row_number() OVER (PARTITION BY usuario_id, conteudo_id, data ORDER BY ordem) AS vez
        FROM (SELECT ordem, usuario_id, conteudo_id, TRY_CAST(avaliacao AS BIGINT) AS avaliacao,
                NULLIF(regexp_replace(comentario, '^\\s+|\\s+$', '', 'g'), '') AS comentario, {normal_tags('tags')} AS tags,
                TRY_CAST(data AS DATE) AS data,
                (CAST(TRY_CAST(avaliacao AS BIGINT) AS VARCHAR) IS DISTINCT FROM avaliacao)
                OR (NULLIF(regexp_replace(comentario, '^\\s+|\\s+$', '', 'g'), '') IS DISTINCT FROM regexp_replace(comentario, '^\\s+|\\s+$', '', 'g'))
                OR (strftime(TRY_CAST(data AS DATE), {DAY}) IS DISTINCT FROM data)
                OR NOT json_valid(tags)
                OR (TRY_CAST(TRY_CAST(tags AS JSON) AS VARCHAR[]) IS DISTINCT FROM {normal_tags('tags')}) AS mudou
              FROM bronze_comentarios)""",
    "documentos": f"""
        SELECT c.ordem, CAST(c.usuario_id AS BIGINT) AS usuario_id, CAST(c.conteudo_id AS BIGINT) AS conteudo_id, c.avaliacao,
          c.comentario, c.tags, c.data, k.categoria
        FROM limpo_comentarios c JOIN limpo_catalogo k ON k.conteudo_id = c.conteudo_id AND k.vez = 1
        WHERE c.vez = 1 AND c.avaliacao BETWEEN 1 AND 5 AND c.comentario IS NOT NULL AND c.data IS NOT NULL
          AND TRY_CAST(k.conteudo_id AS BIGINT) IS NOT NULL AND k.categoria IN {among(CATEGORIES)}""",
    "fato": f"""
        SELECT conteudo_id, CAST(data_hora AS DATE) AS data, count(*) AS total_interacoes,
          count(*) FILTER (WHERE tipo_interacao = 'visualização') AS visualizacoes,
          count(*) FILTER (WHERE tipo_interacao = 'início') AS inicios, count(*) FILTER (WHERE {CONCLUDED}) AS conclusoes,
          count(*) FILTER (WHERE tipo_interacao = 'curtida') AS curtidas, count(avaliacao_atribuida) AS avaliacoes,
          CAST(coalesce(sum(avaliacao_atribuida), 0) AS BIGINT) AS soma_avaliacao,
          CAST(coalesce(sum(tempo_consumido), 0) AS BIGINT) AS tempo_total_min
        FROM silver_interacao GROUP BY ALL""",
    "recomendacao": f"""
        SELECT usuario_id, conteudo_id, gerado_em, pontuacao, posicao,
          CASE WHEN pontuacao <= 40 THEN 'Negativo' WHEN pontuacao >= 70 THEN 'Positivo' ELSE 'Estável' END AS classificacao
        FROM (SELECT *, row_number() OVER (PARTITION BY gerado_em, usuario_id ORDER BY pontuacao DESC, conteudo_id) AS posicao
              FROM (SELECT user_id AS usuario_id, {EVENT_CONTENT} + event_id % 2 AS conteudo_id,
                      TIMESTAMP '2024-02-01' + to_days(CAST(event_id % 2 AS INTEGER)) AS gerado_em,
                      max(CAST((4100 + (event_id * 37) % 5900) / 100.0 AS DECIMAL(5,2))) AS pontuacao
                    FROM events GROUP BY ALL))
        WHERE posicao <= 5""",
    "lote": "SELECT * FROM recomendacao WHERE gerado_em = (SELECT max(gerado_em) FROM recomendacao)",
    "convertidos": """
        SELECT DISTINCT usuario_id, conteudo_id FROM silver_interacao
        WHERE tipo_interacao IN ('visualização', 'início', 'conclusão', 'curtida')""",
    "por_categoria": f"""
        SELECT c.categoria, c.tipo, count(DISTINCT c.conteudo_id) AS qtd_conteudos, count(i.ordem) AS total_interacoes,
          count(i.ordem) FILTER (WHERE i.tipo_interacao = 'visualização') AS visualizacoes,
          count(i.ordem) FILTER (WHERE i.tipo_interacao = 'início') AS inicios,
          count(i.ordem) FILTER (WHERE {CONCLUDED_I}) AS conclusoes,
          count(i.ordem) FILTER (WHERE i.tipo_interacao = 'curtida') AS curtidas, count(i.avaliacao_atribuida) AS avaliacoes,
          {pct(f"count(i.ordem) FILTER (WHERE {CONCLUDED_I})", f"count(i.ordem) FILTER (WHERE {STARTED_I})")} AS taxa,
          {ratio("sum(i.avaliacao_atribuida)", "count(i.avaliacao_atribuida)", 2)} AS nota,
          {ratio("sum(i.tempo_consumido)", "count(i.tempo_consumido)", 1)} AS tempo
        FROM silver_conteudo c LEFT JOIN silver_interacao i ON i.conteudo_id = c.conteudo_id GROUP BY c.categoria, c.tipo""",
    "por_formato": f"""
        SELECT c.tipo, count(DISTINCT c.conteudo_id) AS qtd_conteudos, count(i.ordem) AS total_interacoes,
          count(i.ordem) FILTER (WHERE i.tipo_interacao = 'visualização') AS visualizacoes,
          count(i.ordem) FILTER (WHERE i.tipo_interacao = 'início') AS inicios,
          count(i.ordem) FILTER (WHERE {CONCLUDED_I}) AS conclusoes,
          {pct(f"count(i.ordem) FILTER (WHERE {CONCLUDED_I})", f"count(i.ordem) FILTER (WHERE {STARTED_I})")} AS taxa,
          {ratio("sum(i.avaliacao_atribuida)", "count(i.avaliacao_atribuida)", 2)} AS nota,
          {ratio("sum(i.tempo_consumido)", "count(i.tempo_consumido)", 1)} AS tempo,
          {ratio("sum(c.carga_horaria_min)", "count(c.carga_horaria_min)", 1)} AS carga
        FROM silver_conteudo c LEFT JOIN silver_interacao i ON i.conteudo_id = c.conteudo_id GROUP BY c.tipo""",
    "por_dia": f"""
        SELECT CAST(data_hora AS DATE) AS data, count(*) AS total_interacoes, count(DISTINCT usuario_id) AS usuarios,
          count(*) FILTER (WHERE tipo_interacao = 'visualização') AS visualizacoes,
          count(*) FILTER (WHERE tipo_interacao = 'início') AS inicios, count(*) FILTER (WHERE {CONCLUDED}) AS conclusoes,
          count(*) FILTER (WHERE tipo_interacao = 'curtida') AS curtidas, count(avaliacao_atribuida) AS avaliacoes,
          {ratio("sum(avaliacao_atribuida)", "count(avaliacao_atribuida)", 2)} AS nota, CAST(sum(tempo_consumido) AS BIGINT) AS tempo
        FROM silver_interacao GROUP BY ALL""",
    "por_conteudo": f"""
        SELECT c.conteudo_id, c.titulo, c.categoria, c.tipo, c.nivel, c.carga_horaria_min, c.data_publicacao, c.autor,
          count(i.ordem) AS total_interacoes, count(DISTINCT i.usuario_id) AS usuarios_distintos,
          count(i.ordem) FILTER (WHERE i.tipo_interacao = 'visualização') AS visualizacoes,
          count(i.ordem) FILTER (WHERE {CONCLUDED_I}) AS conclusoes,
          {pct(f"count(i.ordem) FILTER (WHERE {CONCLUDED_I})", f"count(i.ordem) FILTER (WHERE {STARTED_I})")} AS taxa,
          {ratio("sum(i.avaliacao_atribuida)", "count(i.avaliacao_atribuida)", 2)} AS nota,
          {ratio("sum(i.tempo_consumido)", "count(i.tempo_consumido)", 1)} AS tempo
        FROM silver_conteudo c LEFT JOIN silver_interacao i ON i.conteudo_id = c.conteudo_id
        GROUP BY c.conteudo_id, c.titulo, c.categoria, c.tipo, c.nivel, c.carga_horaria_min, c.data_publicacao, c.autor""",
    "conversao": f"""
        SELECT count(*) AS total, count(p.conteudo_id) AS usadas, {pct("count(p.conteudo_id)", "count(*)")} AS taxa,
          strftime(max(l.gerado_em), {INSTANT}) AS lote_gerado_em, max(l.gerado_em) AS instante,
          count(*) FILTER (WHERE classificacao = 'Positivo') AS positivas,
          count(p.conteudo_id) FILTER (WHERE classificacao = 'Positivo') AS positivas_usadas,
          count(*) FILTER (WHERE classificacao = 'Estável') AS estaveis,
          count(p.conteudo_id) FILTER (WHERE classificacao = 'Estável') AS estaveis_usadas
        FROM lote l LEFT JOIN convertidos p ON p.usuario_id = l.usuario_id AND p.conteudo_id = l.conteudo_id""",
    "geral": f"""
        SELECT count(DISTINCT usuario_id) AS usuarios, count(*) AS interacoes, count(avaliacao_atribuida) AS avaliacoes,
          count(*) FILTER (WHERE {CONCLUDED}) AS conclusoes,
          {pct(f"count(*) FILTER (WHERE {CONCLUDED})", f"count(*) FILTER (WHERE {STARTED})")} AS taxa,
          {ratio("sum(avaliacao_atribuida)", "count(avaliacao_atribuida)", 2)} AS nota,
          {ratio("sum(tempo_consumido)", "count(tempo_consumido)", 1)} AS tempo
        FROM silver_interacao""",
    "vetores": """
        SELECT vec_id AS conteudo_id, CASE WHEN vec_id % 50 = 49 THEN 'antigo' ELSE 'base' END AS modelo,
          CAST(embedding AS DOUBLE[]) AS vetor FROM embeddings""",
    "textos": f"""
        SELECT p_partkey AS conteudo_id,
          concat_ws('\n\n', NULLIF(trim(CASE WHEN p_partkey % 53 = 52 THEN '  ' WHEN p_partkey % 7 = 0 THEN upper(p_name)
               WHEN p_partkey % 11 = 0 THEN replace(p_name, ' ', '  ') ELSE p_name END), ''), NULLIF(trim(p_type), '')) AS texto
        FROM part""",
    "guardados": """
        SELECT v.conteudo_id, v.modelo, CASE WHEN v.conteudo_id % 10 = 3 THEN 'v0 ' || t.texto ELSE t.texto END AS texto_origem,
          array_to_string(list_transform(v.vetor, lambda x: CAST(round(x * 1000000) AS BIGINT)), ',') AS vetor
        FROM vetores v JOIN textos t USING (conteudo_id)""",
    "delta": """
        SELECT c.conteudo_id, t.texto AS texto_origem,
          CASE WHEN t.texto = '' THEN 'ignorado_sem_texto' WHEN g.modelo = 'base' AND g.texto_origem = t.texto THEN 'reaproveitado'
               ELSE 'pendente' END AS situacao
        FROM silver_conteudo c JOIN textos t USING (conteudo_id) LEFT JOIN guardados g USING (conteudo_id)""",
    "palavras": """
        SELECT conteudo_id, palavra, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(palavra, ''), lambda l: CAST(ascii(l) AS BIGINT))),
            lambda soma, letra: list_reduce(list_prepend(xor(soma, letra), [CAST(0 AS BIGINT) FOR i IN range(8)]),
              lambda r, i: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END))) % 64 AS casa
        FROM (SELECT conteudo_id, unnest(list_filter(string_split_regex(lower(texto_origem), '\\s+'), lambda p: p <> '')) AS palavra
              FROM delta WHERE situacao = 'pendente')""",
    "codificados": """
        SELECT d.conteudo_id, d.texto_origem, v.vetor FROM delta d JOIN (
          SELECT k.conteudo_id, array_to_string(list(CAST(round(CAST(CAST(coalesce(n, 0) / norma AS FLOAT) AS DOUBLE) * 1000000) AS BIGINT) ORDER BY k.casa), ',') AS vetor
          FROM (SELECT conteudo_id, sqrt(sum(n * n)) AS norma, unnest(range(64)) AS casa
                FROM (SELECT conteudo_id, casa, count(*) AS n FROM palavras GROUP BY ALL) GROUP BY conteudo_id) k
          LEFT JOIN (SELECT conteudo_id, casa, count(*) AS n FROM palavras GROUP BY ALL) c ON c.conteudo_id = k.conteudo_id AND c.casa = k.casa
          GROUP BY k.conteudo_id) v ON v.conteudo_id = d.conteudo_id""",
    "sinais": f"""
        SELECT usuario_id, conteudo_id,
          sum(CASE WHEN tipo_interacao IN ('visualização', 'início', 'conclusão') OR coalesce(tempo_consumido, 0) > 0
                   THEN greatest(coalesce(tempo_consumido, 0), 1) END) AS peso,
          bool_or(tipo_interacao = 'curtida' OR coalesce(avaliacao_atribuida, 0) >= 4) AS positivo,
          bool_or({CONCLUDED}) AS concluido
        FROM silver_interacao GROUP BY ALL""",
    "unidades": """SELECT conteudo_id, list_transform(vetor, lambda x: x / sqrt(list_dot_product(vetor, vetor))) AS vetor
        FROM vetores WHERE modelo = 'base'""",
    "centroide_vis": """
        SELECT usuario_id, list(v ORDER BY d) AS vis FROM (
          SELECT s.usuario_id, t.d, CAST(sum(s.peso * u.vetor[t.d]) AS DOUBLE) / CAST(sum(s.peso) AS DOUBLE) AS v
          FROM sinais s JOIN unidades u USING (conteudo_id), (SELECT unnest(range(1, 65)) AS d) t
          WHERE s.peso IS NOT NULL GROUP BY s.usuario_id, t.d) GROUP BY usuario_id""",
    "centroide_cur": """
        SELECT usuario_id, list(v ORDER BY d) AS cur FROM (
          SELECT s.usuario_id, t.d, avg(u.vetor[t.d]) AS v
          FROM sinais s JOIN unidades u USING (conteudo_id), (SELECT unnest(range(1, 65)) AS d) t
          WHERE s.positivo GROUP BY s.usuario_id, t.d) GROUP BY usuario_id""",
    "partes": """
        SELECT s.usuario_id, c.categoria, CAST(coalesce(sum(s.peso), 0) AS DOUBLE) AS tempo,
          CAST(count(*) FILTER (WHERE s.positivo) AS DOUBLE) AS positivos
        FROM sinais s LEFT JOIN silver_conteudo c USING (conteudo_id) GROUP BY ALL""",
    "cotas": """
        SELECT usuario_id, categoria, coalesce(tempo / NULLIF(sum(tempo) OVER (PARTITION BY usuario_id), 0), 0) AS parte_tempo,
          coalesce(positivos / NULLIF(sum(positivos) OVER (PARTITION BY usuario_id), 0), 0) AS parte_positivos FROM partes""",
    "indices": """
        SELECT u.usuario_id, c.conteudo_id, c.titulo, c.categoria, c.tipo, coalesce(s.concluido, false) AS concluido,
          s.conteudo_id IS NOT NULL AS tocado,
          least(1, greatest(0, coalesce(list_cosine_similarity(v.vis, e.vetor), q.parte_tempo, 0))) AS ivis,
          least(1, greatest(0, coalesce(list_cosine_similarity(k.cur, e.vetor), q.parte_positivos, 0))) AS icur
        FROM (SELECT DISTINCT usuario_id FROM sinais) u CROSS JOIN silver_conteudo c
        LEFT JOIN unidades e ON e.conteudo_id = c.conteudo_id
        LEFT JOIN centroide_vis v ON v.usuario_id = u.usuario_id LEFT JOIN centroide_cur k ON k.usuario_id = u.usuario_id
        LEFT JOIN cotas q ON q.usuario_id = u.usuario_id AND q.categoria = c.categoria
        LEFT JOIN sinais s ON s.usuario_id = u.usuario_id AND s.conteudo_id = c.conteudo_id""",
    "pontos": """
        SELECT *, CASE WHEN concluido THEN 0 ELSE round_even((ivis + icur) / 2 * 100, 2) END AS pontuacao,
          CASE WHEN concluido THEN 0 ELSE 1 END AS iconc FROM indices""",
    "classes": """
        SELECT *, CASE WHEN iconc = 0 OR pontuacao <= 40 THEN 'Negativo' WHEN pontuacao >= 70 THEN 'Positivo' ELSE 'Estável' END
          AS classificacao FROM pontos""",
    "melhores": """
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY usuario_id ORDER BY pontuacao DESC, conteudo_id) AS posicao
                       FROM classes WHERE classificacao <> 'Negativo') WHERE posicao <= 5""",
    "resumo_rec": """
        SELECT (SELECT count(DISTINCT usuario_id) FROM sinais) AS usuarios_processados,
          (SELECT count(DISTINCT usuario_id) FROM sinais) - (SELECT count(DISTINCT usuario_id) FROM melhores) AS usuarios_sem_recomendacao,
          (SELECT count(*) FROM melhores) AS total,
          (SELECT count(*) FROM melhores WHERE classificacao = 'Positivo') AS positivas,
          (SELECT count(*) FROM melhores WHERE classificacao = 'Estável') AS estaveis,
          (SELECT count(*) FROM classes WHERE classificacao = 'Negativo') AS negativas_descartadas,
          (SELECT count(*) FROM classes WHERE iconc = 0) AS negativas_por_conclusao""",
    "chaves": """
        SELECT *, NULLIF(regexp_replace(lower(strip_accents(trim(titulo))), '\\s+', ' ', 'g'), '') AS kt,
          NULLIF(regexp_replace(lower(strip_accents(trim(autor))), '\\s+', ' ', 'g'), '') AS ka FROM silver_conteudo""",
    "grupo": """
        SELECT *, min(conteudo_id) OVER w AS primeiro, count(*) OVER w AS tamanho,
          row_number() OVER (PARTITION BY kt, tipo, ka ORDER BY conteudo_id) AS cadastro,
          row_number() OVER (PARTITION BY kt, tipo, ka ORDER BY data_publicacao DESC NULLS LAST, conteudo_id DESC) AS recencia
        FROM chaves WINDOW w AS (PARTITION BY kt, tipo, ka)""",
    "mestre": """
        SELECT 'CNT-' || CASE WHEN primeiro >= 10000 THEN CAST(primeiro AS VARCHAR) ELSE lpad(CAST(primeiro AS VARCHAR), 5, '0') END AS mestre_id,
          primeiro, max(titulo) FILTER (WHERE cadastro = 1) AS titulo, max(tipo) FILTER (WHERE cadastro = 1) AS tipo,
          max(categoria) FILTER (WHERE cadastro = 1) AS categoria, max(nivel) FILTER (WHERE recencia = 1) AS nivel,
          coalesce(max(carga_horaria_min) FILTER (WHERE recencia = 1), max(carga_horaria_min)) AS carga_horaria_min,
          coalesce(max(data_publicacao) FILTER (WHERE recencia = 1), max(data_publicacao)) AS data_publicacao,
          max(tamanho) AS qtd_registros
        FROM grupo GROUP BY primeiro""",
    "medidas": f"""
        SELECT
          (SELECT coalesce({pct("count(*) FILTER (WHERE trim(titulo) <> '')", "count(*)")}, 0) FROM silver_conteudo) AS completude,
          (SELECT CAST(count(*) FILTER (WHERE percentual_conclusao < 0 OR percentual_conclusao > 100) AS DOUBLE) FROM silver_interacao) AS validade,
          (SELECT CAST(count(*) - count(DISTINCT (usuario_id, conteudo_id, data_hora)) AS DOUBLE) FROM silver_interacao) AS unicidade,
          (SELECT coalesce({pct("count(*) FILTER (WHERE percentual_conclusao >= 100)", "count(*)")}, 100) FROM silver_interacao
             WHERE tipo_interacao = 'conclusão') AS consistencia,
          (SELECT CAST(count(*) AS DOUBLE) FROM silver_comentario c LEFT JOIN silver_conteudo s USING (conteudo_id)
             WHERE s.conteudo_id IS NULL) AS integridade""",
}


def with_ctes(body: str) -> str:
    """Put the named sub-queries a statement needs in front of it."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, sub in CTES.items():
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                visit(sub)
                if name not in needed:
                    needed.append(name)

    visit(body)
    if not needed:
        return body
    listed = ",\n".join(f"{n} AS MATERIALIZED ({CTES[n]})" for n in needed)
    return f"WITH {listed}\n{body}"
