"""Line deduplication by a log-template tree.

A line's place in a tree of fixed depth is its number of tokens and its first
``LEAD`` tokens, tokens with digits masked. Within such a leaf a token is
constant at its position if enough texts have the very same one there (digits
included; a text counts once for each different line); all other tokens are
variable fields, shown as ``<*>``. The tokens so generalised are the line's
template. A template of which enough tokens are constant and which enough
different texts share recurs, and its lines are dropped from all documents.
With ``verbatim`` a line that enough texts hold as it is recurs too, however
short it is and whatever its tokens are.

Texts are counted, not documents, so exact copies of one document make
nothing recur. ``drop_all_recurring_lines``, which the query and the pipeline
use, drops verbatim lines and templates half of whose tokens, at least two, are
constant, whatever their share of a document; each template's
lines stay in one carrier, the document with the smallest id that has one, so
of near copies one stays whole and no template leaves the corpus. With a
``max_share`` there are no carriers, and a document of whose tokens more than
that would go stays whole.

All of it is DataFrame functions. Line texts leave a task only where their
leaf recurs; counts of a hot line are combined before they are shuffled, and
joins on lines may be split.

Defined cases: a null text stays null and has no lines; an empty text is one
empty line; empty lines never drop; a null id is a value of its own; rows
with the same id and text get the same result; an empty table gives an empty
result; columns named ``n_lines``, ``n_dropped`` or starting with ``_l_`` are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitelens.session import materialize

LEAD = 3
MIN_TEXTS = 5
MIN_CONSTANT = 3
MIN_CONSTANT_SHARE = 0.8
MAX_SHARE = 0.5
#: Bounds of ``drop_all_recurring_lines`` for templates with fields; verbatim lines need none.
LEAST_CONSTANT, LEAST_CONSTANT_SHARE = 2, 0.5
FIELD = "<*>"
_FIELD_PATTERN = r"\S*[0-9]\S*"


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _n_tokens(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) + 1


def _leaf(line: Column) -> Column:
    lead = F.substring_index(line, " ", LEAD)
    return F.xxhash64(_n_tokens(line), F.regexp_replace(lead, _FIELD_PATTERN, FIELD))


def _line_rows(docs: DataFrame) -> DataFrame:
    """Non-empty trimmed lines: _l_id, _l_text (hash of the text), pos, line."""
    rows = docs.select("_l_id", "_l_text", F.posexplode(_lines(F.col("_l_body"))).alias("pos", "raw"))
    return rows.select("_l_id", "_l_text", "pos", F.trim("raw").alias("line")).filter("line != ''")


def recurring_lines(lines: DataFrame, occurrences: DataFrame, min_texts: int, min_constant: int, min_constant_share: float,
                    verbatim: bool) -> DataFrame:
    """The line hashes whose template recurs, and their template."""
    texts = occurrences.select("leaf", "line_hash", "_l_text").distinct()
    per_line = texts.groupBy("leaf", "line_hash").agg(F.count(F.lit(1)).alias("n_texts"))
    leaves = per_line.groupBy("leaf").agg(F.sum("n_texts").alias("n")).filter(F.col("n") >= min_texts).select("leaf")
    # One text of each distinct line of these leaves, with the number of texts that have it.
    bodies = (lines.withColumn("leaf", _leaf(F.col("line"))).join(leaves, "leaf", "left_semi")
              .select("leaf", "line").distinct().withColumn("line_hash", F.md5("line")))
    found = materialize(bodies.join(per_line, ["leaf", "line_hash"]), "recurring_leaves")
    tokens = found.select("leaf", "line_hash", "n_texts", F.posexplode(F.split("line", " ")).alias("at", "token"))
    constants = (tokens.groupBy("leaf", "at", "token").agg(F.sum("n_texts").alias("n"))
                 .filter(F.col("n") >= min_texts).select("leaf", "at", "token", F.lit(True).alias("constant")))
    marked = tokens.join(constants, ["leaf", "at", "token"], "left")
    is_constant = F.coalesce("constant", F.lit(False))
    shown = F.when(is_constant, F.col("token")).otherwise(FIELD)
    templates = (marked.groupBy("leaf", "line_hash")
                 .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", shown.alias("t")))), lambda x: x["t"]), " ")
                      .alias("template"), F.sum(is_constant.cast("int")).alias("n_constant"), F.count(F.lit(1)).alias("n_tokens"))
                 .filter((F.col("n_constant") >= min_constant) & (F.col("n_constant") >= min_constant_share * F.col("n_tokens")))
                 .select("leaf", "line_hash", F.md5("template").alias("template")))
    templates = materialize(templates, "line_templates")
    shared = (texts.join(templates, ["leaf", "line_hash"]).select("leaf", "template", "_l_text").distinct()
              .groupBy("leaf", "template").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_texts))
    found = (templates.join(shared, ["leaf", "template"], "left_semi")
             .select("line_hash", F.xxhash64("leaf", "template").alias("template")).distinct())
    if not verbatim:
        return found
    alike = per_line.filter(F.col("n_texts") >= min_texts).join(found, "line_hash", "left_anti")
    return found.unionByName(alike.select("line_hash", F.xxhash64("leaf", "line_hash").alias("template")))


def carried_elsewhere(occurrences: DataFrame, recurring: DataFrame) -> DataFrame:
    """The occurrences of recurring lines that are not in their template's carrier."""
    recurring = materialize(recurring, "recurring_lines")
    row = F.struct(F.col("_l_id").isNull().alias("last"), F.col("_l_id").alias("id"), F.col("_l_text").alias("text"))
    least = occurrences.groupBy("line_hash").agg(F.min(row).alias("least"))  # first of each line, then of the template
    carriers = recurring.join(least, "line_hash").groupBy("template").agg(F.min("least").alias("carrier"))
    carried = recurring.join(carriers, "template").select("line_hash", "carrier")
    own = F.col("_l_id").eqNullSafe(F.col("carrier.id")) & (F.col("_l_text") == F.col("carrier.text"))
    return occurrences.join(carried, "line_hash").filter(~own)


def drop_all_recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``drop_recurring_lines`` with verbatim lines and the least bounds, whatever the lines' share of a document."""
    return drop_recurring_lines(docs, id_col, text_col, max_share=None, min_constant=LEAST_CONSTANT,
                                min_constant_share=LEAST_CONSTANT_SHARE, verbatim=True)


def drop_recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         min_texts: int = MIN_TEXTS, max_share: float | None = MAX_SHARE, min_constant: int = MIN_CONSTANT,
                         min_constant_share: float = MIN_CONSTANT_SHARE, verbatim: bool = False) -> DataFrame:
    """The documents with recurring lines taken out of the text, and n_lines, n_dropped."""
    own = [c for c in docs.columns if not c.startswith("_l_") and c not in ("n_lines", "n_dropped")]
    body = docs.select(F.col(id_col).alias("_l_id"), F.col(text_col).alias("_l_body")).filter(F.col("_l_body").isNotNull())
    body = body.withColumn("_l_text", F.xxhash64("_l_body"))
    lines = _line_rows(body)
    occurrences = materialize(lines.select("_l_id", "_l_text", "pos", _leaf(F.col("line")).alias("leaf"),
                                           F.md5("line").alias("line_hash")), "line_occurrences")
    recurring = recurring_lines(lines, occurrences, min_texts, min_constant, min_constant_share, verbatim)
    gone = occurrences.join(recurring, "line_hash", "left_semi") if max_share is not None else carried_elsewhere(occurrences, recurring)
    going = (gone.groupBy("_l_id", "_l_text")
             .agg(F.collect_set("pos").alias("_l_going"))
             .select(F.col("_l_id").alias("_l_gid"), F.col("_l_text").alias("_l_gtext"), "_l_going"))
    docs = docs.select(*own).withColumn("_l_hash", F.xxhash64(F.col(text_col)))
    joined = docs.join(going, F.col(id_col).eqNullSafe(F.col("_l_gid")) & (F.col("_l_hash") == F.col("_l_gtext")), "left")
    size = lambda line: F.when(F.trim(line) == "", 0).otherwise(_n_tokens(F.trim(line)))
    total = F.aggregate("_l_lines", F.lit(0), lambda a, x: a + size(x))
    lost = F.aggregate("_l_going", F.lit(0), lambda a, i: a + size(F.get("_l_lines", i)))
    stays = F.array_except(F.sequence(F.lit(0), F.size("_l_lines") - 1), F.col("_l_going"))
    kept = F.array_join(F.transform(stays, lambda i: F.get("_l_lines", i)), "\n")
    cut = (joined.withColumn("_l_lines", _lines(F.col(text_col)))
           .withColumn("_l_cut", F.col("_l_going").isNotNull() & (F.lit(True) if max_share is None else lost <= F.lit(max_share) * total)))
    return cut.select(*[F.when(F.col("_l_cut"), kept).otherwise(F.col(c)).alias(c) if c == text_col else F.col(c) for c in own],
                      F.when(F.col("_l_lines").isNull(), 0).otherwise(F.size("_l_lines")).cast("long").alias("n_lines"),
                      F.when(F.col("_l_cut"), F.size("_l_going")).otherwise(0).cast("long").alias("n_dropped"))
