"""The registered queries as plain SQL for DuckDB, written apart from the Spark code."""

from __future__ import annotations

# The English stop words that Spark ML ships.
STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her
hers herself it its itself they them their theirs themselves what which who whom this that these
those am is are was were be been being have has had having do does did doing a an the and but if or
because as until while of at by for with about against between into through during before after
above below to from up down in out on off over under again further then once here there when where
why how all any both each few more most other some such no nor not only own same so than too very s
t can will just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd
they'd i'm you're he's she's it's we're they're i've we've you've they've isn't aren't wasn't
weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't mustn't can't
couldn't cannot could here's how's let's ought that's there's what's when's where's who's why's
would
""".split()

COMMENTS = """
comments AS (
  SELECT 'comment' AS type,
         CAST(e.event_id AS VARCHAR) AS id,
         CAST(e.user_id % 20 AS VARCHAR) AS subreddit_id,
         e.event_type AS subreddit_name,
         (l.toxic = 1) AS subreddit_nsfw,
         CAST(floor(epoch(e.ts)) AS BIGINT) AS created_utc,
         concat('/c/', CAST(e.event_id AS VARCHAR)) AS permalink,
         CASE WHEN e.event_id % 101 = 0 THEN NULL ELSE d.text END AS body,
         CASE WHEN e.event_id % 97 = 0 THEN NULL
              ELSE CAST((e.event_id * 37) % 201 - 100 AS DOUBLE) / 100 END AS sentiment,
         CASE WHEN e.event_id % 89 = 0 THEN NULL
              ELSE CAST((e.event_id * 53) % 307 - 100 AS BIGINT) END AS score
  FROM events e
  CROSS JOIN (SELECT count(*) AS n_docs FROM documents) k
  JOIN documents d ON d.doc_id = e.event_id % k.n_docs
  LEFT JOIN labels l ON l.doc_id = d.doc_id
),
timed AS (
  SELECT *, make_timestamp(created_utc * 1000000) AS ts FROM comments
)
"""


def _places(value: str, places: int = 6) -> str:
    """Rounded as `_comparable` does it, without a negative zero."""
    return f"round({value} + 1e-9, {places}) + 0.0"


def _mean(column: str) -> str:
    return _places(f"avg({column})")


DAILY = f"""
SELECT date_trunc('day', ts) AS periodo, {_mean('sentiment')} AS avg_sentiment,
       count(*) AS volumen
FROM timed GROUP BY 1
"""

# {times} is the relation with a ts column.
PATTERN = f"""
SELECT dia_semana, hora,
       CASE dia_semana WHEN 1 THEN 'Domingo' WHEN 2 THEN 'Lunes' WHEN 3 THEN 'Martes'
            WHEN 4 THEN 'Miércoles' WHEN 5 THEN 'Jueves' WHEN 6 THEN 'Viernes'
            ELSE 'Sábado' END AS nombre_dia,
       {_mean('score')} AS score_promedio,
       count(*) AS volumen,
       {_mean('sentiment')} AS sentiment_promedio
FROM (SELECT CAST(dayofweek(ts) + 1 AS INTEGER) AS dia_semana, CAST(hour(ts) AS INTEGER) AS hora,
             score, sentiment FROM {{times}})
GROUP BY dia_semana, hora
"""

UNKNOWN_TIMES = """
(SELECT CASE WHEN CAST(id AS BIGINT) % 83 <> 0 THEN ts END AS ts, score, sentiment FROM timed)
"""


def _anomalies(threshold: int) -> str:
    return f"""
SELECT periodo, volumen, {_places('sentimiento')} AS sentiment_promedio,
       {_places('media')} AS media_movil, {_places('desvio')} AS std_movil,
       {_places('z')} AS desviacion_std,
       CASE WHEN z > {threshold} THEN 'Pico Alto' ELSE 'Caída Brusca' END AS es_anomalia
FROM (
  SELECT *, (volumen - media) / nullif(desvio, 0) AS z
  FROM (
    SELECT *, avg(volumen) OVER w AS media, stddev_samp(volumen) OVER w AS desvio
    FROM (
      SELECT date_trunc('hour', ts) AS periodo, count(*) AS volumen,
             avg(sentiment) AS sentimiento
      FROM timed GROUP BY 1
    )
    WINDOW w AS (ORDER BY periodo ROWS BETWEEN 24 PRECEDING AND CURRENT ROW)
  )
)
WHERE abs(z) > {threshold}
"""


CHECK = f"""
SELECT CASE WHEN score > 100 THEN 'Alto' WHEN score < -10 THEN 'Bajo' ELSE 'Neutro' END
         AS rango_score,
       {_mean('sentiment')} AS avg_sentiment_real,
       {_places('stddev_samp(sentiment)')} AS desviacion_sentiment
FROM comments GROUP BY 1
"""

MATRIX = """
SELECT CASE WHEN score >= 50 THEN 'Muy Alto (50+)' WHEN score >= 10 THEN 'Alto (10-49)'
            WHEN score >= 0 THEN 'Positivo (0-9)' WHEN score >= -5 THEN 'Bajo (-5 a -1)'
            ELSE 'Muy Bajo (<-5)' END AS rango_score,
       CASE WHEN sentiment >= 0.5 THEN 'Muy Positivo' WHEN sentiment >= 0.1 THEN 'Positivo'
            WHEN sentiment >= -0.1 THEN 'Neutral' WHEN sentiment >= -0.5 THEN 'Negativo'
            ELSE 'Muy Negativo' END AS rango_sentiment,
       count(*) AS cantidad
FROM comments GROUP BY 1, 2
"""

EXTREMES = """
SELECT id, subreddit_name, created_utc, score, sentiment, extremo_tipo,
       substr(body, 1, 200) AS preview_texto
FROM (
  SELECT *,
         CASE WHEN score > 100 AND sentiment > 0.7 THEN 'Viral Positivo'
              WHEN score < -20 AND sentiment < -0.7 THEN 'Controversial Negativo'
              WHEN abs(score) > 100 THEN 'Alto Engagement'
              WHEN abs(sentiment) > 0.8 THEN 'Sentimiento Extremo'
              ELSE 'Normal' END AS extremo_tipo
  FROM comments
)
WHERE extremo_tipo <> 'Normal'
ORDER BY abs(score) DESC NULLS LAST, id
LIMIT 500
"""

CONTROVERSY = f"""
SELECT subreddit_name,
       CASE WHEN score < 0 AND sentiment < -0.3 THEN 'Controversial Negativo'
            WHEN score > 20 AND sentiment > 0.5 THEN 'Viral Positivo'
            WHEN abs(sentiment) < 0.2 THEN 'Neutral'
            ELSE 'Normal' END AS tipo_contenido,
       count(*) AS cantidad,
       {_mean('score')} AS score_promedio,
       {_mean('sentiment')} AS sentiment_promedio
FROM comments GROUP BY 1, 2
"""

COMPARISON = f"""
SELECT *, {_places('total_comentarios / greatest(dias_activos, 1)')} AS comentarios_por_dia
FROM (
  SELECT *, CAST(date_diff('day', primer_comentario, ultimo_comentario) AS INTEGER)
              AS dias_activos
  FROM (
    SELECT subreddit_name, count(*) AS total_comentarios,
           {_mean('sentiment')} AS sentiment_promedio,
           {_places('stddev_samp(sentiment)')} AS sentiment_std,
           {_mean('score')} AS score_promedio,
           count(*) FILTER (WHERE subreddit_nsfw) AS contenido_nsfw,
           min(ts) AS primer_comentario, max(ts) AS ultimo_comentario
    FROM timed GROUP BY subreddit_name
  )
)
"""

TOP_WORDS = r"""
SELECT sentiment_categoria, word, frecuencia, CAST(pos AS INTEGER) AS rank
FROM (
  SELECT *, row_number() OVER (PARTITION BY sentiment_categoria
                               ORDER BY frecuencia DESC, word) AS pos
  FROM (
    SELECT sentiment_categoria, word, count(*) AS frecuencia
    FROM (
      SELECT CASE WHEN sentiment > 0.3 THEN 'Positivo' WHEN sentiment < -0.3 THEN 'Negativo'
                  ELSE 'Neutral' END AS sentiment_categoria,
             unnest(string_split(
               regexp_replace(lower(body), '[^a-záéíóúñü0-9\s\x0B]', ' ', 'g'), ' ')) AS word
      FROM comments WHERE body IS NOT NULL
    )
    WHERE length(word) > 3
    GROUP BY 1, 2
  )
)
WHERE pos <= 50
"""

WORD_COUNT = r"""
SELECT palabra, count(*) AS count
FROM (
  SELECT unnest(regexp_split_to_array(
    regexp_replace(lower(text), '[^a-záéíóúñü\s\x0B]', ' ', 'g'), '[\s\x0B]+')) AS palabra
  FROM documents
)
WHERE palabra <> ''
GROUP BY 1
"""

CLEANED = r"""
SELECT id, md5(cleaned) AS clean_md5, CAST(length(cleaned) AS INTEGER) AS chars
FROM (
  SELECT id, regexp_replace(lower(body), '[^a-záéíóúñü0-9\s\x0B]', ' ', 'g') AS cleaned
  FROM comments
)
"""

_TERMS = r"""
terms AS (
  SELECT id, unnest(regexp_split_to_array(
           regexp_replace(lower(body), '[^a-záéíóúñü0-9\s\x0B]', ' ', 'g'), '[\s\x0B]+')) AS term
  FROM comments WHERE body IS NOT NULL
)
"""


def _vocabulary(occurrences: str) -> str:
    stop = ", ".join("'" + word.replace("'", "''") + "'" for word in STOP_WORDS)
    return f"""
SELECT term, documents, occurrences
FROM (
  SELECT term, count(DISTINCT id) AS documents, {occurrences} AS occurrences
  FROM terms WHERE term <> '' AND term NOT IN ({stop})
  GROUP BY term
)
WHERE documents >= 0.05 * (SELECT count(*) FROM comments WHERE body IS NOT NULL)
ORDER BY occurrences DESC, term
LIMIT 3000
"""


HEATMAP = f"""
SELECT nombre_dia AS dia_nombre, dia_semana, hora, volumen AS intensidad_actividad,
       sentiment_promedio AS sentimiento
FROM ({PATTERN.format(times='timed')})
"""

RANKING = f"""
SELECT subreddit_name, total_comentarios, sentiment_promedio,
       CASE WHEN sentiment_promedio > 0.2 THEN 'Positivo'
            WHEN sentiment_promedio < -0.2 THEN 'Negativo' ELSE 'Neutro' END
         AS etiqueta_sentimiento,
       comentarios_por_dia AS velocidad_actividad
FROM ({COMPARISON})
WHERE total_comentarios > 50
"""

ALERTS = f"""
SELECT periodo, es_anomalia AS tipo_anomalia, volumen, sentiment_promedio
FROM ({_anomalies(3)})
"""

SCAN = """
SELECT type, id, subreddit_id, subreddit_name, subreddit_nsfw, created_utc, permalink,
       md5(body) AS body, sentiment, score
FROM comments
"""

LANDED = """
SELECT CAST(ts AS DATE) AS day, count(*) AS comments, count(body) AS bodies,
       CAST(sum(score) AS BIGINT) AS score_sum, CAST(sum(length(body)) AS BIGINT) AS characters
FROM timed GROUP BY 1
"""

SERVING_CLEANUP = f"""
SELECT CASE WHEN day(periodo) % 7 <> 0 THEN periodo END AS periodo, avg_sentiment, volumen
FROM ({DAILY})
"""

DECLARED_CHECKS = f"""
SELECT count(*) AS rows,
       count(*) FILTER (WHERE dia_semana IS NULL) AS dia_semana_not_null,
       count(*) FILTER (WHERE nombre_dia IS NULL) AS nombre_dia_not_null,
       count(*) FILTER (WHERE hora IS NULL) AS hora_not_null,
       count(*) FILTER (WHERE NOT hora BETWEEN 0 AND 23) AS hora_in_day
FROM ({PATTERN.format(times=UNKNOWN_TIMES)})
"""

RESULT_SQL = {
    "tendencias_diarias": DAILY,
    "patrones_horarios": PATTERN.format(times="timed"),
    "anomalias": _anomalies(3),
    "validacion_sentimiento": CHECK,
    "distribucion_sentiment_score": MATRIX,
    "controversia_por_subreddit": CONTROVERSY,
    "comparativa_subreddits": COMPARISON,
    "comentarios_extremos": EXTREMES,
    "top_palabras_sentimiento": TOP_WORDS,
}

# A number per result that changes with its values, as SQL that both engines read.
CONTROL_TOTALS = {
    "tendencias_diarias": "sum(volumen * (1 + avg_sentiment))",
    "patrones_horarios": "sum((1 + dia_semana) * score_promedio + hora * sentiment_promedio)",
    "anomalias": "sum(volumen + media_movil + std_movil + desviacion_std)",
    "validacion_sentimiento": "sum(avg_sentiment_real + desviacion_sentiment)",
    "distribucion_sentiment_score":
        "sum(cantidad * (length(rango_score) + 10 * length(rango_sentiment)))",
    "controversia_por_subreddit":
        "sum(cantidad * length(tipo_contenido) + score_promedio + sentiment_promedio)",
    "comparativa_subreddits":
        "sum(comentarios_por_dia + sentiment_std + score_promedio + contenido_nsfw)",
    "comentarios_extremos": "sum(score * length(extremo_tipo) + length(preview_texto) + sentiment)",
    "top_palabras_sentimiento": "sum(frecuencia * rank + length(word))",
}

VIEWS = {
    "view_heatmap_semanal": HEATMAP,
    "view_ranking_subreddits": RANKING,
    "view_alertas_recientes": ALERTS,
}


def _with(body: str, *more: str) -> str:
    return "WITH " + ", ".join([COMMENTS, *more]) + body


FULL_RUN = "\nUNION ALL\n".join(
    f"SELECT '{table}' AS output, count(*) AS rows, "
    f"{_places(f'CAST({total} AS DOUBLE)', 3)} AS control_total FROM ({RESULT_SQL[table]})"
    for table, total in CONTROL_TOTALS.items()
)

# Columns of each result and view in order; d is a double, t a time, s anything else.
ROW_COLUMNS = {
    "tendencias_diarias": "periodo:t avg_sentiment:d volumen:s",
    "patrones_horarios":
        "dia_semana:s hora:s nombre_dia:s score_promedio:d volumen:s sentiment_promedio:d",
    "anomalias": "periodo:t volumen:s sentiment_promedio:d media_movil:d std_movil:d "
        "desviacion_std:d es_anomalia:s",
    "validacion_sentimiento": "rango_score:s avg_sentiment_real:d desviacion_sentiment:d",
    "distribucion_sentiment_score": "rango_score:s rango_sentiment:s cantidad:s",
    "controversia_por_subreddit":
        "subreddit_name:s tipo_contenido:s cantidad:s score_promedio:d sentiment_promedio:d",
    "comparativa_subreddits": "subreddit_name:s total_comentarios:s sentiment_promedio:d "
        "sentiment_std:d score_promedio:d contenido_nsfw:s primer_comentario:t "
        "ultimo_comentario:t dias_activos:s comentarios_por_dia:d",
    "comentarios_extremos": "id:s subreddit_name:s created_utc:s score:s sentiment:d "
        "extremo_tipo:s preview_texto:s",
    "top_palabras_sentimiento": "sentiment_categoria:s word:s frecuencia:s rank:s",
    "view_heatmap_semanal":
        "dia_nombre:s dia_semana:s hora:s intensidad_actividad:s sentimiento:d",
    "view_ranking_subreddits": "subreddit_name:s total_comentarios:s sentiment_promedio:d "
        "etiqueta_sentimiento:s velocidad_actividad:d",
    "view_alertas_recientes": "periodo:t tipo_anomalia:s volumen:s sentiment_promedio:d",
}


def _row_text(name: str) -> str:
    """A row as `_row_text` of the Spark side writes it."""
    kinds = {
        "d": f"CAST(CAST({_places('{c}')} AS DECIMAL(20,6)) AS VARCHAR)",
        "t": "strftime({c}, '%Y-%m-%d %H:%M:%S')",
        "s": "CAST({c} AS VARCHAR)",
    }
    columns = [column.split(":") for column in ROW_COLUMNS[name].split()]
    texts = [f"coalesce({kinds[kind].format(c=column)}, '-')" for column, kind in columns]
    return f"concat_ws('|', {', '.join(texts)}) AS row_text"


PUBLISHED = "\nUNION ALL\n".join(
    f"SELECT '{table}' AS \"table\", 'published' AS status, {_row_text(table)} FROM ({sql})"
    for table, sql in RESULT_SQL.items()
)

RESULT_VIEWS = "\nUNION ALL\n".join(
    f"SELECT '{view}' AS \"view\", {_row_text(view)} FROM ({sql})" for view, sql in VIEWS.items()
)

REJECTS = """
SELECT kind, CASE WHEN kind = 'bad_value' THEN 'score' ELSE '' END AS bad_columns,
       count(*) AS records, CAST(sum(n) AS BIGINT) AS id_sum,
       CAST(sum(CASE WHEN kind IN ('accepted', 'long_row') THEN score END) AS BIGINT) AS score_sum,
       CAST(sum(CASE WHEN kind <> 'unclosed_quote' THEN length(body) END) AS BIGINT) AS characters
FROM (
  SELECT *, CASE WHEN n < 16 THEN 'unclosed_quote' WHEN n % 211 = 0 THEN 'short_row'
                 WHEN n % 223 = 0 THEN 'long_row' WHEN n % 227 = 0 THEN 'bad_value'
                 ELSE 'accepted' END AS kind
  FROM (SELECT *, CAST(id AS BIGINT) AS n FROM comments)
)
GROUP BY 1, 2
"""

TOPIC_CHECKS = """
SELECT CAST(topic AS INTEGER) AS topic, CAST(20 AS INTEGER) AS distinct_terms,
       CAST(20 AS INTEGER) AS known_terms, true AS falling_weights, true AS better_than_one_topic
FROM range(5) AS topics(topic)
"""

ORACLES = {
    "daily_trend": _with(DAILY),
    "hourly_pattern": _with(PATTERN.format(times="timed")),
    "hourly_pattern_unknown_times": _with(PATTERN.format(times=UNKNOWN_TIMES)),
    "activity_anomalies": _with(_anomalies(3)),
    "activity_anomalies_sigma2": _with(_anomalies(2)),
    "sentiment_by_score_band": _with(CHECK),
    "score_sentiment_matrix": _with(MATRIX),
    "extreme_comments": _with(EXTREMES),
    "community_controversy": _with(CONTROVERSY),
    "community_comparison": _with(COMPARISON),
    "activity_anomalies_from_summary": _with(_anomalies(2)),
    "activity_anomalies_blocks": _with(_anomalies(2)),
    "score_sentiment_matrix_from_summary": _with(MATRIX),
    "community_comparison_from_summary": _with(COMPARISON),
    "top_words_by_sentiment": _with(TOP_WORDS),
    "word_count": WORD_COUNT,
    "cleaned_text": _with(CLEANED),
    "topic_vocabulary": _with(_vocabulary("count(DISTINCT id)"), _TERMS),
    "topic_vocabulary_counts": _with(_vocabulary("count(*)"), _TERMS),
    "topics_lda_checks": TOPIC_CHECKS,
    "weekly_heatmap": _with(HEATMAP),
    "community_ranking": _with(RANKING),
    "recent_alerts": _with(ALERTS),
    "csv_scan": _with(SCAN),
    "csv_scan_split": _with(SCAN),
    "bronze_landing": _with(LANDED),
    "dataset_landing": _with(LANDED),
    "landing_rejects": _with(REJECTS),
    "result_round_trip": _with(EXTREMES),
    "result_round_trip_csv": _with(EXTREMES),
    "serving_cleanup": _with(SERVING_CLEANUP),
    "declared_checks": _with(DECLARED_CHECKS),
    "published_results": _with(PUBLISHED),
    "result_views": _with(RESULT_VIEWS),
    "full_run_outputs": _with(FULL_RUN),
}
