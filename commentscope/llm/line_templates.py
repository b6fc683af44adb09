"""Op 9, line dedup: recurring line templates are dropped, by a log-template tree.

Method: a tree of fixed depth. A line goes to a leaf by its number of tokens and its leading
tokens; tokens with a digit are variable fields, written `<*>`. In a leaf, the line that most
documents hold is the model; lines that agree with it in enough places are of its template, and
their other tokens are variable fields too. Of the lines that no model has taken the next model is
chosen, until those left in a leaf are in too few documents to recur, so a leaf can have several
templates. A template, or a line as it is, that enough documents hold is recurring, and its lines
are dropped. `SQL` has the first template of each leaf only.

Documents with the same text count once. In the query, as its SQL has it, lines of few tokens stay,
and a document that recurring lines make up for the most part stays whole, for near-duplicate
removal. The pipeline judges short lines as they are, and spares of such a document only lines that
near copies of it hold and too few others.

All steps of the query are DataFrame functions. The lines are stored once, so each text is taken apart once.
Shuffled rows hold hashes of lines; only lines of leaves that enough documents reach are shuffled
as text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..storage import new_dir
from .common import SPACES, stored, table

MIN_DOCUMENTS = 5
MIN_TOKENS = 5
DEPTH = 3
SIMILARITY = 0.8
MAX_LOSS = 0.5
# Documents that hold a line under MIN_TOKENS tokens, where such lines are judged.
SHORT_DOCUMENTS = 10

# Sketch of a text that tells near copies: least hashes of its five-word runs in so many parts of the
# hash space, so many of which side by side make a key, and the share in which near copies agree.
SKETCH = 32
BAND = 4
AGREEMENT = 0.72
HOPS = 3

# Leaves and lines whose hashes fit this many bytes are broadcast, others are joined by shuffle.
MAX_BROADCAST_BYTES = 32 << 20

# Lines of a leaf from which a round takes models, and tokens of these, so that a leaf's choice, which
# compares each line with the models before it, stays a short step of one task.
BATCH_LINES = 512
BATCH_TOKENS = 1 << 15
# Bytes that a token of a model takes about, and the parts into which leaves are dealt where models
# are too many to broadcast.
TOKEN_BYTES = 24
LEAF_SHARDS = 16


# A token with a digit. Matching starts where tokens do and never goes back.
NUMBERED = "(?<![^ \n])[^ \n0-9]*+[0-9][^ \n]*+"


def masked(text: Column) -> Column:
    """A text whose lines have single spaces between tokens and `<*>` for tokens with a digit.

    Works on whole texts: most need neither step, which a few byte searches tell.
    """
    irregular = [text.contains(c) for c in ("  ", " \n", "\n ", "\t", "\r", "\x0b", "\x0c")]
    irregular += [text.startswith(" "), text.endswith(" ")]
    spaced = F.regexp_replace(text, r"[\x20\x09\x0B-\x0D]+", " ")
    spaced = F.btrim(F.regexp_replace(spaced, " ?\n ?", "\n"), F.lit(" "))
    spaced = F.when(reduce(Column.__or__, irregular), spaced).otherwise(text)
    return F.when(
        spaced.rlike("[0-9]"), F.regexp_replace(spaced, NUMBERED, "<*>")
    ).otherwise(spaced)


def tokens_in(line: Column) -> Column:
    gaps = F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit("")))
    return F.when(line == "", 0).otherwise(gaps + 1).cast("long")


def line_table(
    documents: DataFrame,
    *,
    text: str = "text",
    min_tokens: int = MIN_TOKENS,
    depth: int = DEPTH,
) -> DataFrame:
    """`doc` (hash of the text), `words` (tokens of the text), `at`, `masked`, `tokens`, `leaf` and
    `line` (hash of the masked line) of each line with enough tokens."""
    tokens = tokens_in(F.col("masked")).alias("tokens")
    # Spaces part the tokens of a line; each line that is not blank has one token more.
    gaps = F.length("whole") - F.length(F.replace("whole", F.lit(" "), F.lit("")))
    words = gaps + F.size(F.array_remove("lines", ""))
    return (
        documents.where(F.col(text).isNotNull())
        # Hashed and masked before the lines part: once per text, not once per line.
        .select(F.xxhash64(text).alias("doc"), masked(F.col(text)).alias("whole"))
        .select("doc", "whole", F.split("whole", "\n").alias("lines"))
        .select("doc", words.cast("long").alias("words"), "lines")
        # The outer form: for the plain one the optimizer would add a filter on the size of the
        # list, and compute it twice.
        .select("doc", "words", F.posexplode_outer("lines").alias("at", "masked"))
        .select("doc", "words", "at", "masked", tokens)
        .where(F.col("tokens") >= min_tokens)
        .select(
            "*",
            F.xxhash64("tokens", F.substring_index("masked", " ", depth)).alias("leaf"),
            F.xxhash64("masked").alias("line"),
        )
    )


def _bounded(df: DataFrame) -> DataFrame:
    """`df`, a stored table of one hash a row, marked for broadcast if it is small enough."""
    return F.broadcast(df) if df.count() * 8 <= MAX_BROADCAST_BYTES else df


def _alike(words: Column, other: Column, similarity: float) -> Column:
    """Whether two lists of as many tokens agree in enough places."""
    agree = F.size(F.filter(F.zip_with(words, other, lambda a, b: a == b), lambda same: same))
    return 100 * agree >= round(100 * similarity) * F.size(words)


def _models(rest: DataFrame, similarity: float) -> DataFrame:
    """`leaf` and `models`, tokens of those among the leaf's first lines that agree with no model
    before them. All lines of smaller leaves are among the first."""
    order = Window.partitionBy("leaf").orderBy(F.desc("n"), "masked")
    place = F.col("place")
    first = (
        rest.select("leaf", "masked", "tokens", F.row_number().over(order).alias("place"))
        .where(place <= BATCH_LINES)
        .where((place == 1) | (place * F.col("tokens") <= BATCH_TOKENS))
        .groupBy("leaf")
        .agg(F.sort_array(F.collect_list(F.struct("place", "masked"))).alias("first"))
    )
    models = F.aggregate(
        F.transform("first", lambda line: F.split(line["masked"], " ")),
        F.array().cast("array<array<string>>"),
        lambda models, line: F.when(
            F.exists(models, lambda model: _alike(line, model, similarity)), models
        ).otherwise(F.concat(models, F.array(line))),
    )
    return first.select("leaf", models.alias("models"))


def _judged(rest: DataFrame, models: DataFrame, similarity: float) -> DataFrame:
    """`rest` with `unit`, the hash of the first model that a line agrees with, or null. `models` is
    stored."""
    tokens = models.agg(F.sum(F.size(F.flatten("models")))).first()[0] or 0
    on = ["leaf"]
    names = rest.columns
    if tokens * TOKEN_BYTES <= MAX_BROADCAST_BYTES:
        models = F.broadcast(models)
    else:
        # A leaf of many lines is dealt to several tasks.
        on = ["leaf", "shard"]
        rest = rest.withColumn("shard", F.pmod("line", F.lit(LEAF_SHARDS)))
        shards = F.sequence(F.lit(0).cast("long"), F.lit(LEAF_SHARDS - 1).cast("long"))
        models = models.withColumn("shard", F.explode(shards))
    words = F.split("masked", " ")
    model = F.aggregate(
        "models",
        F.lit(None).cast("array<string>"),
        # The first one stays: no other is compared after it.
        lambda found, model: F.coalesce(found, F.when(_alike(words, model, similarity), model)),
    )
    return (
        rest.join(models, on)
        .withColumn("model", model)
        .select(
            *names,
            F.when(
                F.col("model").isNotNull(), F.xxhash64("leaf", F.array_join("model", " "))
            ).alias("unit"),
        )
    )


def recurring_lines(
    lines: DataFrame, *, min_documents: int = MIN_DOCUMENTS, similarity: float = SIMILARITY
) -> DataFrame:
    """`line`, the hash of each masked line that is to be dropped, and `unit`, the hash of the
    template it is of, or its own if enough documents hold it as it is. From a stored `line_table`.
    """
    reached = (
        lines.select("leaf", "doc")
        .distinct()
        .groupBy("leaf")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= min_documents)
        .select("leaf")
    )
    reached = _bounded(stored(reached, "leaves"))
    held = lines.join(reached, "leaf").select("leaf", "line", "masked", "tokens", "doc").distinct()
    held = stored(held, "leaf-lines")
    rest = stored(
        held.groupBy("leaf", "line", "masked", "tokens").agg(F.count("*").alias("n")), "rest-lines"
    )
    alone = rest.where(F.col("n") >= min_documents).select("line", F.col("line").alias("unit"))
    found = new_dir(lines.sparkSession, "template-lines")
    # Each round takes one line at least from each leaf that is left, so the rounds end.
    while True:
        models = stored(_models(rest, similarity), "models")
        judged = stored(_judged(rest, models, similarity), "judged-lines")
        judged.where("unit is not null").select("line", "unit").write.mode("append").parquet(found)
        # What is left of a leaf recurs only if its lines are in enough documents together; these
        # are no more than the lines' own documents.
        left = (
            judged.where("unit is null")
            .groupBy("leaf")
            .agg(F.sum("n").alias("n"))
            .where(F.col("n") >= min_documents)
            .select("leaf")
        )
        left = stored(left, "leaves-left")
        if left.isEmpty():
            break
        rest = stored(
            judged.where("unit is null").drop("unit").join(left, "leaf", "left_semi"), "rest-lines"
        )
    taken = lines.sparkSession.read.schema("line bigint, unit bigint").parquet(found)
    wide = (
        held.select("line", "doc")
        .join(taken, "line")
        .select("unit", "doc")
        .distinct()
        .groupBy("unit")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= min_documents)
        .select("unit")
    )
    return alone.unionByName(taken.join(wide, "unit").select("line", "unit")).distinct()


def short_lines(lines: DataFrame, *, min_documents: int) -> DataFrame:
    """`line` and `unit`, both its hash, of each line that so many documents hold as it is."""
    held = lines.select("line", "doc").distinct().groupBy("line").agg(F.count("*").alias("n"))
    return held.where(F.col("n") >= min_documents).select("line", F.col("line").alias("unit"))


def copy_groups(texts: DataFrame) -> DataFrame:
    """`doc`, `group` for texts `doc`, `text` (distinct docs, no nulls), read once, by DataFrame
    functions only: near copies, with about 0.8 of their five-word runs in common, are in one group,
    whose name is one of them.

    Texts with an equal key meet its first text; those whose sketch agrees with that text's take its
    group, and groups of groups are followed `HOPS` times. A text under five words is one run.
    """
    words = F.filter(F.split("text", f"[{SPACES}]+"), lambda w: w != "")
    # The list beside itself, shifted: a hash passes over the nulls that fill up a text of fewer words.
    starts = F.greatest(F.size("words") - 4, F.lit(1))
    names = [f"w{k}" for k in range(1, 6)]
    shifted = [F.slice("words", k, starts).alias(n) for k, n in enumerate(names, 1)]
    run = F.xxhash64(*names)
    part = F.col("part")
    sketches = stored(
        texts.select("doc", words.alias("words"))
        .select("doc", F.inline_outer(F.arrays_zip(*shifted)))
        .select("doc", run.alias("run"))
        .groupBy("doc", F.pmod("run", F.lit(SKETCH)).alias("part"))
        .agg(F.min("run").alias("run"))
        .groupBy("doc")
        .agg(F.array(*[F.min(F.when(part == k, F.col("run"))) for k in range(SKETCH)]).alias("sketch")),
        "sketches",
    )
    # Parts without a run, as short texts have them, tell nothing.
    bands = [F.slice("sketch", k + 1, BAND) for k in range(0, SKETCH, BAND)]
    keys = F.array_compact(
        F.array(
            *[
                F.when(F.size(F.array_compact(band)) > 0, F.xxhash64(F.lit(k), band))
                for k, band in enumerate(bands)
            ]
        )
    )
    rows = sketches.select("doc", F.explode(keys).alias("key"))
    # Keys travel without sketches; these meet once for each pair of a text and a first one.
    firsts = rows.groupBy("key").agg(F.min("doc").alias("first"))
    pairs = stored(rows.join(firsts, "key").select("doc", "first").distinct(), "copy-pairs")
    meet = (
        pairs.where("doc <> first")
        .join(sketches, "doc")
        .join(sketches.select(F.col("doc").alias("first"), F.col("sketch").alias("other")), "first")
    )
    both = F.zip_with("sketch", "other", lambda a, b: F.when(a.isNotNull() | b.isNotNull(), a.eqNullSafe(b)))
    agree = F.size(F.filter(both, lambda same: same))
    links = stored(
        meet.where(agree >= AGREEMENT * F.size(F.array_compact(both)))
        .select("doc", "first")
        # A first text agrees with itself.
        .unionByName(pairs.where("doc = first"))
        .groupBy("doc")
        .agg(F.min("first").alias("group")),
        "copy-links",
    )
    groups = links
    for _ in range(HOPS):
        onward = links.select(F.col("doc").alias("group"), F.col("group").alias("next"))
        groups = groups.join(onward, "group", "left").select(
            "doc", F.coalesce("next", "group").alias("group")
        )
    return groups


def _beyond_copies(
    documents: DataFrame, lines: DataFrame, doomed: DataFrame, heavy: DataFrame, *, text: str
) -> DataFrame:
    """`doc`, `at`, `tokens` of the lines in the documents `heavy` that recur beyond copies: near
    copies of each other (as `copy_groups` has them) count as one holder of a line or template. `doomed` has `line`, `unit` and `needed`."""
    own = stored(
        lines.join(heavy, "doc", "left_semi").join(doomed, "line").select(
            "doc", "at", "tokens", "unit"
        ),
        "heavy-lines",
    )
    units = doomed.join(own.select("unit").distinct(), "unit", "left_semi")
    holders = stored(
        lines.join(units, "line").select("unit", "needed", "doc").distinct(), "holders"
    )
    texts = (
        documents.select(F.xxhash64(text).alias("doc"), F.col(text).alias("text"))
        .join(holders.select("doc").distinct(), "doc", "left_semi")
        .dropDuplicates(["doc"])
    )
    groups = copy_groups(texts)
    wide = (
        holders.join(groups, "doc")
        .select("unit", "needed", "group")
        .distinct()
        .groupBy("unit", "needed")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= F.col("needed"))
        .select("unit")
    )
    return own.join(wide, "unit", "left_semi").select("doc", "at", "tokens").distinct()


def drop_recurring_lines(
    documents: DataFrame,
    *,
    text: str = "text",
    max_loss: float = MAX_LOSS,
    min_documents: int = MIN_DOCUMENTS,
    min_tokens: int = MIN_TOKENS,
    depth: int = DEPTH,
    similarity: float = SIMILARITY,
    short_documents: int | None = None,
    judge_copies: bool = False,
) -> DataFrame:
    """`documents` with recurring lines taken out of `text`, and `n_lines`, `n_dropped`.

    A text keeps its other lines as they are, joined by line breaks. One that would lose more than
    the share `max_loss` of its tokens stays whole; with `judge_copies`, it only keeps the lines
    that recur in near copies of it and not beyond. Lines under `min_tokens` tokens stay, or with
    `short_documents`, go where so many documents hold them. Lines without a token stay. Null texts stay null and have no lines; an
    empty text has one, which stays. Repeated rows are kept, and count as one document. Columns of
    `documents` that are named like the two new ones are replaced.
    """
    least = min_tokens if short_documents is None else 1
    lines = stored(line_table(documents, text=text, min_tokens=least, depth=depth), "lines")
    long = F.col("tokens") >= min_tokens
    doomed = recurring_lines(
        lines.where(long), min_documents=min_documents, similarity=similarity
    ).withColumn("needed", F.lit(min_documents))
    if short_documents is not None:
        short = short_lines(lines.where(~long), min_documents=short_documents)
        doomed = doomed.unionByName(short.withColumn("needed", F.lit(short_documents)))
    doomed = stored(doomed, "recurring")
    gone = (
        lines.join(_bounded(stored(doomed.select("line").distinct(), "doomed")), "line")
        .select("doc", "words", "at", "tokens")
        .distinct()  # rows with the same text
    )
    lost = F.sum("tokens").alias("_lost")
    light = 100 * F.col("_lost") <= round(100 * max_loss) * F.col("words")
    if judge_copies:
        gone = stored(gone, "gone-lines")
        heavy = stored(
            gone.groupBy("doc", "words").agg(lost).where(~light).select("doc"), "heavy"
        )
        wide = _beyond_copies(documents, lines, doomed, heavy, text=text)
        gone = gone.join(heavy, "doc", "left_anti").drop("words").unionByName(wide)
        dropped = gone.groupBy("doc").agg(F.collect_set("at").alias("_at")).withColumn("_loses", F.lit(True))
    else:
        dropped = (
            gone.groupBy("doc", "words")
            .agg(F.collect_set("at").alias("_at"), lost)
            .select("doc", "_at", light.alias("_loses"))
        )
    names = [n for n in documents.columns if n not in ("n_lines", "n_dropped")]
    whole = F.split(text, "\n")
    kept = F.array_join(
        F.filter(whole, lambda line, at: ~F.array_contains(F.col("_at"), at)), "\n"
    )
    return (
        documents.withColumn("_doc", F.xxhash64(text))
        .join(dropped.withColumnRenamed("doc", "_doc"), "_doc", "left")
        .withColumn("_loses", F.coalesce("_loses", F.lit(False)))
        .select(
            *[
                F.when(F.col("_loses"), kept).otherwise(F.col(n)).alias(n) if n == text else F.col(f"`{n}`")
                for n in names
            ],
            F.when(F.col(text).isNull(), 0).otherwise(F.size(whole)).cast("long").alias("n_lines"),
            F.when(F.col("_loses"), F.size("_at")).otherwise(0).cast("long").alias("n_dropped"),
        )
    )


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_recurring_lines(documents)


_MASKED = f"""
regexp_replace(trim(regexp_replace(line, '[{SPACES}]+', ' ', 'g'), ' '),
               '[^ ]*[0-9][^ ]*', '<*>', 'g')
"""

SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, text FROM documents
), split AS (
  SELECT r, text, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS place
  FROM docs WHERE text IS NOT NULL
), lines AS (
  SELECT r, text, place, line, {_MASKED} AS masked FROM split
), tokens AS (
  SELECT r, text, place, line, masked, CASE WHEN masked = '' THEN 0 ELSE len(string_split(masked, ' ')) END AS n
  FROM lines
), held AS (
  SELECT DISTINCT text, masked, n, string_split(masked, ' ')[1:{DEPTH}] AS lead
  FROM tokens WHERE n >= {MIN_TOKENS}
), counted AS (
  SELECT n, lead, masked, count(*) AS docs FROM held GROUP BY ALL
), models AS (
  SELECT n, lead, masked AS model FROM counted
  QUALIFY row_number() OVER (PARTITION BY n, lead ORDER BY docs DESC, masked) = 1
), judged AS (
  SELECT n, lead, masked, docs >= {MIN_DOCUMENTS} AS alone,
         100 * len(list_filter(list_zip(string_split(masked, ' '), string_split(model, ' ')),
                               lambda p: p[1] = p[2])) >= {round(100 * SIMILARITY)} * n AS alike
  FROM counted JOIN models USING (n, lead)
), templates AS (
  SELECT n, lead FROM held JOIN judged USING (n, lead, masked) WHERE alike
  GROUP BY n, lead HAVING count(DISTINCT text) >= {MIN_DOCUMENTS}
), doomed AS (
  SELECT DISTINCT masked FROM judged LEFT JOIN templates t USING (n, lead)
  WHERE alone OR (alike AND t.n IS NOT NULL)
), marked AS (
  SELECT r, place, line, n, n >= {MIN_TOKENS} AND masked IN (SELECT masked FROM doomed) AS gone
  FROM tokens
), summed AS (
  SELECT r, 100 * coalesce(sum(n) FILTER (gone), 0) <= {round(100 * MAX_LOSS)} * sum(n) AS loses,
         count(*) AS n_lines, count(*) FILTER (gone) AS gone_lines,
         string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone) AS kept
  FROM marked GROUP BY r
)
SELECT doc_id, CASE WHEN loses AND gone_lines > 0 THEN coalesce(kept, '') ELSE text END AS text,
       CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines,
       CAST(CASE WHEN loses THEN gone_lines ELSE 0 END AS BIGINT) AS n_dropped
FROM docs LEFT JOIN summed USING (r)
"""
