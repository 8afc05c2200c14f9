"""Encyclopedia articles: cleaning with reject reasons, samples, lookups, OCR documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tamis.functions import wikitext as w
from tamis.functions.cleaning import ocr_elements_to_text
from tamis.functions.rules import Rule, apply_rules, rewrite_column
from tamis.functions.text import byte_count, flatten_for_training, matches_title, preview, title_line, word_count
from tamis.operators.cleaning import rule_examples
from tamis.operators.rows import running_total
from tamis.session import pin


ARTICLE_STEPS = [r for group in w.ARTICLE_RULES.values() for r in group]


def clean_articles(df: DataFrame, text_col: str = "text", min_length: int = 100, redirects: bool = True) -> DataFrame:
    """Clean text with counts and ``reject_reason`` (redirect, too_short or null).

    ``redirects=False`` is the text-only form.
    """
    raw = F.col(text_col)
    redirect = w.is_redirect(raw) if redirects else F.lit(False)
    out = rewrite_column(df.withColumn("_redirect", redirect), text_col, ARTICLE_STEPS)
    out = pin(out, text_col, F.col(text_col))
    short = F.length(text_col) < min_length
    out = out.withColumn("reject_reason", F.when(F.col("_redirect"), "redirect").when(short, "too_short")).drop("_redirect")
    return out.withColumns({"word_count": word_count(F.col(text_col)), "byte_count": byte_count(F.col(text_col))})


def article_rule_examples(df: DataFrame, id_col: str, cap: int = 20, text_col: str = "text") -> DataFrame:
    """Before/after texts per rule group."""
    groups = [Rule(name, function=(lambda rules: lambda c: apply_rules(c, rules))(rules)) for name, rules in w.ARTICLE_RULES.items()]
    return rule_examples(df, groups, id_col, cap, text_col)


def valid_articles(df: DataFrame, min_length: int = 500, text_col: str = "text") -> DataFrame:
    """Pages of the main namespace with enough text that are no redirects."""
    body = F.col(text_col)
    return df.where((F.col("ns") == 0) & body.isNotNull() & (F.length(body) >= min_length) & ~w.is_redirect(body))


def sample_articles(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Articles with their parts and quality score."""
    raw = F.col(text_col)
    parts = df.withColumns({
        "categories": w.categories(raw), "infobox": w.infobox(raw), "tables": w.table_notes(raw),
        "_content": apply_rules(raw, w.LEFTOVER_RULES), "original_length": F.length(raw),
    })
    parts = parts.withColumns({"summary": w.summary(F.col("_content")), "content": flatten_for_training(w.mark_headings(F.col("_content")))})
    score = w.quality_score(F.col("content"), F.size("categories"), F.col("infobox"), F.col("summary"))
    return parts.withColumns({"processed_length": F.length("content"), "quality_score": score}).drop("_content", text_col)


def quality_bands(df: DataFrame) -> DataFrame:
    return df.groupBy(w.quality_band(F.col("quality_score")).alias("band")).agg(F.count(F.lit(1)).alias("articles"))


def find_by_title(df: DataFrame, title: str, title_col: str = "title") -> DataFrame:
    return df.where(F.col(title_col) == title)


def starting_with_title(df: DataFrame, title: str, text_col: str = "text") -> DataFrame:
    return df.where(matches_title(F.col(text_col), title))


def similar_titles(df: DataFrame, title: str, id_col: str, text_col: str = "text", limit: int = 5) -> DataFrame:
    """The first few articles whose first line contains the title, case aside."""
    first = title_line(F.col(text_col))
    hits = df.where(F.lower(first).contains(title.lower()))
    return hits.select(id_col, preview(first, 80).alias("title_line")).orderBy(id_col).limit(limit)


def containing_anywhere(df: DataFrame, term: str) -> DataFrame:
    """Rows with the term in any string, nested ones included."""
    return df.where(F.to_json(F.struct("*")).contains(term))


def chunk_source(uri: Column) -> Column:
    """File name of a chunk address: what stands before ``_chunk_``."""
    return F.substring_index(F.substring_index(uri, "/", -1), "_chunk_", 1)


def chunk_number(uri: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(uri, r"_chunk_(\d+)", 1), F.lit("")).cast("long"), F.lit(0))


def response_parts(request: Column, response: Column) -> tuple[Column, Column]:
    """File address and response text of a model record given as JSON; null where absent."""
    uri = F.get_json_object(request, "$.contents[*].parts[*].file_data.file_uri")
    # A single match comes back as a JSON string, several as a list.
    uri = F.regexp_extract(uri, r'"?([^"\[\],]+)"?', 1)
    return F.nullif(uri, F.lit("")), F.get_json_object(response, "$.candidates[0].content.parts[0].text")


def judge_scores(response_text: Column) -> Column:
    return F.from_json(response_text, "score int, comments string, recommendations string")


def assemble_chunks(df: DataFrame, file: str, order: str, text: str, separator: str = "") -> DataFrame:
    """Chunks of each file in order, joined into one document; a file is one document's worth of text."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t"))))
    return df.groupBy(file).agg(F.array_join(F.transform(ordered, lambda s: s["t"]), separator).alias("text"))


def assemble_pieces(df: DataFrame, file: str, order: str | list[str], text: str, separator: str = "", piece_chars: int = 1 << 26) -> DataFrame:
    """``file, piece, text``: the chunks of each file in order, joined into pieces of about ``piece_chars``.

    A file of any size is cut where its running length passes a multiple of the limit, so neither a row
    nor a task has to hold it; pieces in order, with the separator between them, are the whole file.
    No piece exceeds the limit by more than a chunk.  Null texts are left out.
    """
    keys = [order] if isinstance(order, str) else list(order)
    size = F.length(text).cast("long") + len(separator)
    placed = running_total(df.where(F.col(text).isNotNull()).select(file, *keys, text), keys, size, "_end", [file])
    numbered = placed.withColumn("piece", F.floor((F.col("_end") - size) / F.lit(piece_chars)).cast("long"))
    ordered = F.array_sort(F.collect_list(F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], F.col(text).alias("t"))))
    return numbered.groupBy(file, "piece").agg(F.array_join(F.transform(ordered, lambda s: s["t"]), separator).alias("text"))


def ocr_documents(df: DataFrame) -> DataFrame:
    """Whole documents from OCR responses ``request, response`` (JSON); unreadable chunks are skipped."""
    uri, text = response_parts(F.col("request"), F.col("response"))
    chunks = df.select(uri.alias("uri"), ocr_elements_to_text(text).alias("text")).where("uri IS NOT NULL AND text IS NOT NULL")
    placed = chunks.select(chunk_source(F.col("uri")).alias("filename"), chunk_number(F.col("uri")).alias("chunk_id"), "text")
    return assemble_chunks(placed, "filename", "chunk_id", "text")


def judge_request(custom_id: Column, prompt: str, text: Column, system: str, limit: int = 10_000) -> Column:
    """Request record as JSON; the text is cut to what the judged prompt may hold."""
    part = F.substring(text, 1, limit)
    return F.to_json(F.struct(
        custom_id.alias("custom_id"),
        F.struct(
            F.array(F.struct(F.lit("user").alias("role"), F.array(F.struct(F.lit(prompt).alias("text")), F.struct(part.alias("text"))).alias("parts"))).alias("contents"),
            F.struct(F.array(F.struct(F.lit(system).alias("text"))).alias("parts")).alias("system_instruction"),
        ).alias("request"),
    ))
