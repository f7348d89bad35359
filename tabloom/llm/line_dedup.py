"""Recurring lines by a tree of line templates, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.functions.lineage import materialize
from tabloom.llm.common import free_name, join_groups, maybe_broadcast

#: Documents in which a template must occur to be recurring.
MIN_DOCUMENTS = 10
#: Words of the shortest line that may have fields; of a shorter one all words must be equal.
FIELD_WORDS = 4
#: Leading words that, with the number of words, lead to a leaf of the tree.
LEADING_WORDS = 2
#: Share of a template's words that must be fixed.
FIXED_SHARE = 0.5

FIELD = "<*>"
#: Anything but white space.
INK = r"[^\s\p{Z}]"


def masked(line: Column) -> Column:
    """A line with every run of digits as 0, without spaces around it."""
    return F.trim(F.regexp_replace(line, "[0-9]+", "0"))


def line_templates(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_documents: int = MIN_DOCUMENTS,
    min_words: int = 1,
    fixed_share: float = FIXED_SHARE,
) -> tuple[DataFrame, DataFrame]:
    """The lines that have a recurring template, and the templates.

    A line descends by its number of words and its leading words (digits masked) to a leaf. Within a
    leaf a word at a place is fixed if the leaf's lines have it there in at least `min_documents`
    documents; any other is a variable field. Lines of under FIELD_WORDS words descend by all of their
    words and have no field; of white space alone they are not looked at. Single spaces part words. Lines of
    under `min_words` words are left out. Lines: doc_id, line_no, template, is_first. Templates:
    template, documents. A document counts once for a line, however often it has it.
    """
    source = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    lines = source.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    lines = lines.select("doc_id", "line_no", masked(F.col("line")).alias("line"))
    words = F.split("line", " ")
    path = F.slice(words, 1, F.when(F.col("n") < FIELD_WORDS, F.col("n")).otherwise(F.lit(LEADING_WORDS)))
    lines = lines.where("line != ''").withColumn("n", F.size(words)).where(F.col("n") >= min_words)
    lines = lines.where((F.col("n") >= FIELD_WORDS) | F.col("line").rlike(INK))
    lines = lines.withColumn("leaf", F.xxhash64("n", path))

    # A leaf of few lines has no recurring template: most lines end here, as two numbers each.
    full = lines.groupBy("leaf").agg(F.count("*").alias("c")).where(F.col("c") >= min_documents)
    full = materialize(full.select("leaf"), "full-leaves")
    kept = materialize(lines.join(maybe_broadcast(full), "leaf", "left_semi").drop("n"), "leaf-lines")
    total = kept.count()

    in_documents = kept.select("leaf", "line", "doc_id").distinct()
    distinct = in_documents.groupBy("leaf", "line").agg(F.count("*").alias("documents"))
    # Its words are shuffled with the number of a line and not with its text.
    distinct = materialize(distinct.withColumn("line_id", F.monotonically_increasing_id()), "distinct-lines")
    placed = distinct.select(
        "leaf", "line_id", "documents", F.posexplode(F.split("line", " ")).alias("place", "word")
    )
    fixed = placed.groupBy("leaf", "place", "word").agg(F.sum("documents").alias("support"))
    fixed = materialize(fixed.where(F.col("support") >= min_documents), "fixed-words")
    marked = join_groups(placed, fixed, ["leaf", "place", "word"], "support", total, "left")
    part = F.struct("place", F.when(F.col("support").isNull(), F.lit(FIELD)).otherwise(F.col("word")).alias("part"))
    templates = marked.groupBy("line_id").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(part)), lambda x: x["part"]), " ").alias("template"),
        F.avg(F.when(F.col("support").isNull(), 0.0).otherwise(1.0)).alias("fixed"),
        F.count("*").alias("n"),
    )
    least = F.when(F.col("n") < FIELD_WORDS, 1.0).otherwise(fixed_share)
    templates = templates.where(F.col("fixed") >= least).join(distinct, "line_id")
    templates = materialize(templates.select("leaf", "line", "documents", "template"), "line-templates")

    found = join_groups(
        kept, templates, ["leaf", "line"], "documents", total
    ).select("doc_id", "line_no", "template")
    found = materialize(found, "template-lines")
    counts = found.select("template", "doc_id").distinct().groupBy("template").agg(F.count("*").alias("documents"))
    first = found.groupBy("template").agg(F.min(F.struct("doc_id", "line_no")).alias("first"))
    recurring = counts.where(F.col("documents") >= min_documents).join(first, "template")
    recurring = materialize(recurring, "recurring-templates")
    hits = join_groups(found, recurring, ["template"], "documents", total).select(
        "doc_id",
        "line_no",
        "template",
        ((F.col("doc_id") == F.col("first.doc_id")) & (F.col("line_no") == F.col("first.line_no"))).alias("is_first"),
    )
    return hits, recurring.select("template", "documents")


def dedup_lines(df: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Every row with the lines of recurring templates taken out of its text, plus dropped_lines.

    The first line of each template (smallest doc_id, then smallest line number) stays. Lines are cut at
    \\n; blank lines always stay, as do all lines of rows without a doc_id. A NULL text stays NULL.
    Rows that repeat a doc_id lose the same line numbers. Other columns are kept, but for one with the name of the new column. Options are those of line_templates().
    """
    hits, _ = line_templates(df.where(F.col(doc_id).isNotNull()), doc_id, text, **options)
    lost, of = free_name(df.columns, "_gone"), free_name(df.columns, "_gone_doc")
    gone = hits.where(~F.col("is_first")).groupBy(F.col("doc_id").alias(of))
    gone = gone.agg(F.collect_set("line_no").alias(lost))
    base = df.drop("dropped_lines")
    # A NULL id meets nothing: such rows are spread by their text and not joined in one task.
    key = F.when(F.col(doc_id).isNull(), -F.abs(F.xxhash64(text)) - 1).otherwise(F.col(doc_id).cast("long"))
    joined = base.join(gone, (key == F.col(of)) & F.col(doc_id).isNotNull(), "left")
    left = F.array_join(
        F.filter(F.split(text, "\n"), lambda line, i: ~F.array_contains(F.col(lost), i)), "\n"
    )
    dropped = F.when(F.col(lost).isNull(), 0).otherwise(F.size(lost))
    joined = joined.withColumn("dropped_lines", dropped.cast("long"))
    new_text = F.when(F.col(lost).isNull(), F.col(text)).otherwise(left)
    return joined.withColumn(text, new_text).select(*base.columns, "dropped_lines")


ORACLE = f"""
    WITH lines AS (
        SELECT doc_id, i - 1 AS line_no,
            trim(regexp_replace(string_split(text, chr(10))[i], '[0-9]+', '0', 'g')) AS line
        FROM documents, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS u(i)
    ), split AS (
        SELECT *, string_split(line, ' ') AS words FROM lines WHERE line != ''
    ), leaves AS (
        SELECT doc_id, line_no, line, words, len(words) || ' ' || array_to_string(
                words[1:CASE WHEN len(words) < {FIELD_WORDS} THEN len(words) ELSE {LEADING_WORDS} END], ' ') AS leaf
        FROM split WHERE len(words) >= {FIELD_WORDS} OR regexp_matches(line, '[^\\x09-\\x0D \\p{{Z}}]')
    ), full_leaves AS (
        SELECT leaf FROM leaves GROUP BY leaf HAVING count(*) >= {MIN_DOCUMENTS}
    ), kept AS (
        SELECT * FROM leaves WHERE leaf IN (SELECT leaf FROM full_leaves)
    ), same AS (
        SELECT leaf, line, any_value(words) AS words, count(DISTINCT doc_id) AS documents FROM kept GROUP BY leaf, line
    ), placed AS (
        SELECT leaf, line, documents, p AS place, words[p] AS word FROM same, unnest(range(1, len(words) + 1)) AS u(p)
    ), fixed AS (
        SELECT leaf, place, word FROM placed GROUP BY leaf, place, word HAVING sum(documents) >= {MIN_DOCUMENTS}
    ), templates AS (
        SELECT p.leaf, p.line,
            string_agg(CASE WHEN f.leaf IS NULL THEN '{FIELD}' ELSE p.word END, ' ' ORDER BY p.place) AS template
        FROM placed p LEFT JOIN fixed f ON p.leaf = f.leaf AND p.place = f.place AND p.word = f.word
        GROUP BY p.leaf, p.line
        HAVING avg(CASE WHEN f.leaf IS NULL THEN 0.0 ELSE 1.0 END)
            >= CASE WHEN count(*) < {FIELD_WORDS} THEN 1.0 ELSE {FIXED_SHARE} END
    ), found AS (
        SELECT k.doc_id, k.line_no, t.template FROM kept k JOIN templates t ON k.leaf = t.leaf AND k.line = t.line
    ), recurring AS (
        SELECT template, min((doc_id, line_no)) AS first FROM found
        GROUP BY template HAVING count(DISTINCT doc_id) >= {MIN_DOCUMENTS}
    ), gone AS (
        SELECT doc_id, list(DISTINCT line_no) AS gone FROM found JOIN recurring USING (template)
        WHERE (doc_id, line_no) != first GROUP BY doc_id
    )
    SELECT d.doc_id, coalesce(len(gone), 0) AS dropped_lines,
        CASE WHEN gone IS NULL THEN text ELSE array_to_string(list_filter(string_split(text, chr(10)),
            lambda x, i: NOT list_contains(gone, i - 1)), chr(10)) END AS text
    FROM documents d LEFT JOIN gone g ON d.doc_id = g.doc_id"""
