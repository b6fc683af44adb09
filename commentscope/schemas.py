"""Declared schemas of the input and of every result, and the step that makes a frame conform."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

STRING, LONG, INT, DOUBLE = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()
TIMESTAMP, BOOLEAN = T.TimestampType(), T.BooleanType()


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


COMMENTS = _struct(
    type=STRING,
    id=STRING,
    subreddit_id=STRING,
    subreddit_name=STRING,
    subreddit_nsfw=BOOLEAN,
    created_utc=LONG,
    permalink=STRING,
    body=STRING,
    sentiment=DOUBLE,
    score=LONG,
)

# Column names of a raw comment file, in file order.
RAW_HEADER = [
    "type",
    "id",
    "subreddit.id",
    "subreddit.name",
    "subreddit.nsfw",
    "created_utc",
    "permalink",
    "body",
    "sentiment",
    "score",
]

RAW_COMMENTS = T.StructType(
    [T.StructField(raw, f.dataType) for raw, f in zip(RAW_HEADER, COMMENTS.fields)]
)


@dataclass(frozen=True)
class ResultTable:
    """A result: its columns, those that must not be NULL, and further row checks as SQL."""

    columns: T.StructType
    required: tuple[str, ...] = ()
    checks: dict[str, str] = field(default_factory=dict)


RESULTS: dict[str, ResultTable] = {
    "tendencias_diarias": ResultTable(
        _struct(periodo=TIMESTAMP, avg_sentiment=DOUBLE, volumen=LONG),
        required=("periodo",),
    ),
    "temas_lda": ResultTable(
        _struct(topic=INT, terms=T.ArrayType(STRING), termWeights=T.ArrayType(DOUBLE)),
        required=("topic", "terms", "termWeights"),
    ),
    "validacion_sentimiento": ResultTable(
        _struct(rango_score=STRING, avg_sentiment_real=DOUBLE, desviacion_sentiment=DOUBLE),
        required=("rango_score",),
    ),
    "controversia_por_subreddit": ResultTable(
        _struct(
            subreddit_name=STRING,
            tipo_contenido=STRING,
            cantidad=LONG,
            score_promedio=DOUBLE,
            sentiment_promedio=DOUBLE,
        ),
        required=("subreddit_name", "tipo_contenido"),
    ),
    "patrones_horarios": ResultTable(
        _struct(
            dia_semana=INT,
            hora=INT,
            nombre_dia=STRING,
            score_promedio=DOUBLE,
            volumen=LONG,
            sentiment_promedio=DOUBLE,
        ),
        required=("dia_semana", "nombre_dia", "hora"),
        checks={"hora_in_day": "hora BETWEEN 0 AND 23"},
    ),
    "top_palabras_sentimiento": ResultTable(
        _struct(sentiment_categoria=STRING, word=STRING, frecuencia=LONG, rank=INT),
        required=("sentiment_categoria", "word", "frecuencia", "rank"),
    ),
    "anomalias": ResultTable(
        _struct(
            periodo=TIMESTAMP,
            volumen=LONG,
            sentiment_promedio=DOUBLE,
            media_movil=DOUBLE,
            std_movil=DOUBLE,
            desviacion_std=DOUBLE,
            es_anomalia=STRING,
        ),
        required=("periodo", "es_anomalia"),
    ),
    "comparativa_subreddits": ResultTable(
        _struct(
            subreddit_name=STRING,
            total_comentarios=LONG,
            sentiment_promedio=DOUBLE,
            sentiment_std=DOUBLE,
            score_promedio=DOUBLE,
            contenido_nsfw=LONG,
            primer_comentario=TIMESTAMP,
            ultimo_comentario=TIMESTAMP,
            dias_activos=INT,
            comentarios_por_dia=DOUBLE,
        ),
        required=("subreddit_name",),
    ),
    "distribucion_sentiment_score": ResultTable(
        _struct(rango_score=STRING, rango_sentiment=STRING, cantidad=LONG),
        required=("rango_score", "rango_sentiment"),
    ),
    "comentarios_extremos": ResultTable(
        _struct(
            id=STRING,
            subreddit_name=STRING,
            created_utc=LONG,
            score=LONG,
            sentiment=DOUBLE,
            extremo_tipo=STRING,
            preview_texto=STRING,
        ),
    ),
}


def conform(df: DataFrame, table: str) -> DataFrame:
    """The declared columns in declared order and type; text that does not parse becomes NULL."""
    declared = RESULTS[table].columns
    missing = [f.name for f in declared if f.name not in df.columns]
    if missing:
        raise ValueError(f"{table}: columns missing from the result: {', '.join(missing)}")
    actual = dict(df.dtypes)
    return df.select(
        *[
            F.col(f.name)
            if actual[f.name] == f.dataType.simpleString()
            else F.col(f.name).try_cast(f.dataType).alias(f.name)
            for f in declared
        ]
    )


def violation_counts(table: str) -> list[Column]:
    """Aggregates: rows, and rows that break each declared rule of `table`."""
    spec = RESULTS[table]
    counts = [F.count_if(F.col(c).isNull()).alias(f"{c}_not_null") for c in spec.required]
    counts += [F.count_if(~F.expr(rule)).alias(name) for name, rule in spec.checks.items()]
    return [F.count("*").alias("rows"), *counts]


def violations(df: DataFrame, table: str) -> DataFrame:
    """One row with the counts of `violation_counts`."""
    return df.agg(*violation_counts(table))
