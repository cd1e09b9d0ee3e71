"""Step 2: graph extraction (M1, M4, M5, M6; F2-F4, F8, F9, P3-P6, A2-A7, A11, A14, J3).

Mentions are shuffled once, by key: the ordered list of a key's mentions gives its count, documents, first
description and the descriptions of its summary prompt (P6), which holds them all in one row anyway.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import ModelConfig
from ..functions import prompts as P
from ..functions.text import composite_key, error_prefix, normalize_name, numbered_lines, stable_id
from ..schemas import SUMMARY_PAYLOAD
from . import model as M

ENTITY_KEY = ["title", "type"]
REL_KEY = ["source", "target"]


def _type(v: Column) -> Column:
    """Type name of a VARIANT (``VOID`` for a JSON null); NULL where the field is missing."""
    return F.schema_of_variant(v)


def _text_of(v: Column) -> Column:
    """a name as the model must give it; a missing one is blank."""
    return F.coalesce(F.try_variant_get(v, "$", "string"), F.lit(""))


def _odd_name(v: Column, field: str) -> Column:
    return F.when(v.isNotNull() & (_type(v) != "STRING"), F.lit(f"{field} not a string"))


#: Elements of a payload before their names are normalised.
FIELDS = ("name", "type", "source", "target", "description", "weight")
ENTRY = ("kind: string, pos: int, reason: string, name: string, type: string, source: string, target: string, "
         "description: string, weight: double, text_prefix: string")


def _entry(kind: str, pos: Column, reason: Column, text_prefix: Column, **fields: Column) -> Column:
    """A struct of ``ENTRY``; fields that are not given, and those of an element that is not usable, are null."""
    given = {"kind": F.lit(kind), "pos": pos.cast("int"), "reason": reason, "text_prefix": text_prefix, **fields}
    return F.struct(*[given.get(n, F.lit(None)).cast(t).alias(n) for n, t in (f.split(": ") for f in ENTRY.split(", "))])


def _judged(kind: str, x: Column) -> Column:
    """The entry of an element whose fields were taken out of a VARIANT: its values, or why it is not usable."""
    described = _type(x["description"])
    description = (F.when(x["description"].isNull() | (described == "VOID"), F.lit(""))
                   .when(described == "STRING", F.try_variant_get(x["description"], "$", "string"))
                   .otherwise(F.to_json(x["description"])))
    fields = {"description": description}
    if kind == "entity":
        odd = F.coalesce(_odd_name(x["name"], "name"), _odd_name(x["type"], "type"))
        fields |= {"name": _text_of(x["name"]), "type": F.when(x["type"].isNull(), F.lit("CONCEPT")).otherwise(_text_of(x["type"]))}
    else:
        weight, odd_weight = _weight(x["weight"])
        odd = F.coalesce(_odd_name(x["source"], "source"), _odd_name(x["target"], "target"), odd_weight)
        fields |= {"source": _text_of(x["source"]), "target": _text_of(x["target"]), "weight": weight}
    reason = F.when(~F.startswith(_type(x["e"]), F.lit("OBJECT")), F.lit("not an object")).otherwise(odd)
    return F.when(reason.isNull(), _entry(kind, x["pos"], F.lit(None), F.lit(None), **fields)).otherwise(
        _entry(kind, x["pos"], reason, error_prefix(F.to_json(x["e"]))))


def _entries(kind: str, field: str) -> Column:
    """The elements of one array of a payload as structs of ``ENTRY``; a container that is no array is one
    entry at position -1, a missing one is none."""
    whole = F.try_variant_get(F.col("json"), f"$.{field}", "variant")
    items = F.try_variant_get(F.col("json"), f"$.{field}", "array<variant>")
    taken = F.transform(items, lambda e, i: F.struct(i.alias("pos"), e.alias("e"), *[
        F.try_variant_get(e, f"$.{n}", "variant").alias(n) for n in FIELDS]))
    return (F.when(items.isNotNull(), F.transform(taken, lambda x: _judged(kind, x)))
            .when(whole.isNotNull(), F.array(_entry(kind, F.lit(-1), F.lit(f"{field} not an array"), error_prefix(F.to_json(whole)))))
            .otherwise(F.array().cast(f"array<struct<{ENTRY}>>")))


#: A payload whose values have the types that are asked for.
PLAIN_PAYLOAD = ("entities array<struct<name: string, type: string, description: string>>, "
                 "relationships array<struct<source: string, target: string, description: string, weight: double>>")


def _plain_entries(kind: str, field: str) -> Column:
    """The elements of one array of a plain payload, as ``_entries`` gives them."""
    text = lambda x, *names: {n: F.coalesce(x[n], F.lit("")) for n in names}
    own = {"entity": lambda x: {**text(x, "name", "description"), "type": F.coalesce(x["type"], F.lit("CONCEPT"))},
           "relationship": lambda x: {**text(x, "source", "target", "description"),
                                      "weight": F.coalesce(x["weight"] + F.lit(0.0), F.lit(1.0))}}[kind]  # -0.0 is 0.0
    return F.coalesce(F.transform(F.col(f"typed.{field}"), lambda x, i: _entry(kind, i, F.lit(None), F.lit(None), **own(x))),
                      F.array().cast(f"array<struct<{ENTRY}>>"))


def _is_plain() -> Column:
    """Whether a payload read by ``PLAIN_PAYLOAD`` lost nothing: written again it is the same text (other types or fields,
    repeated keys, nulls and other spellings give another one), it has no null element and finite weights only."""
    # the option also keeps the optimizer from taking the text itself for what is written
    again = F.to_json("typed", {"ignoreNullFields": "true"})
    odd = F.exists("typed.entities", lambda x: x.isNull()), F.exists("typed.relationships", lambda x: x.isNull() | F.isnan(
        x["weight"]) | (F.abs(x["weight"]) == float("inf")))
    return F.coalesce((again == F.col("response_text")) & ~F.coalesce(odd[0], F.lit(False)) & ~F.coalesce(odd[1], F.lit(False)), F.lit(False))


def _weight(v: Column) -> tuple[Column, Column]:
    """a weight and why it is not usable: numbers, booleans and numeric texts are taken, missing and null are 1.0."""
    kind = _type(v)
    text = F.regexp_replace(F.try_variant_get(v, "$", "string"), r"^\s+|\s+$", "")
    number = (F.when(v.isNull() | (kind == "VOID"), F.lit(1.0))
              .when(kind == "STRING", F.when(text.rlike(NUMBER_TEXT), text.try_cast("double"))
                    .when(text.rlike(NOT_FINITE_TEXT), F.lit(float("inf"))))
              .when(kind == "BOOLEAN", F.try_variant_get(v, "$", "boolean").cast("double"))
              .otherwise(F.try_variant_get(v, "$", "double")))
    reason = (F.when(number.isNull(), F.lit("weight not a number"))
              .when(F.isnan(number) | (F.abs(number) == float("inf")), F.lit("weight not finite")))
    return number, reason


#: Texts that count as numbers, and those that name a value that is not finite (fixed values).
NUMBER_TEXT = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$"
NOT_FINITE_TEXT = r"(?i)^[+-]?(nan|inf|infinity)$"


def elements(parsed: DataFrame) -> DataFrame:
    """One row per element of a usable payload, good or not.

    ``document_id``, ``kind`` (entity or relationship), ``pos`` (-1: the container itself), ``reason``, the element's
    columns, ``text_prefix`` of an element that is not usable. An element is judged on its own: a malformed one is
    quarantined with its ``reason`` and takes no other with it. A blank name or endpoint is no fault; such rows have
    no reason and are left out of the mentions (P4, P5). Each payload is parsed once for both kinds; the elements of one
    whose text a typed reading loses nothing of are taken from that (no type tests, no look-up field by field), all
    others from the VARIANT. Either way an element is judged inside its array: the projection of all elements stays so
    small that the JVM compiles it.
    """
    either = F.when(F.col("is_plain"), F.concat(_plain_entries("entity", "entities"), _plain_entries("relationship", "relationships"))) \
        .when(M.unusable("json").isNull(), F.concat(_entries("entity", "entities"), _entries("relationship", "relationships")))
    # what a typed reading loses nothing of is written JSON, so it is usable; only other texts are read as a VARIANT
    rows = (parsed.select("document_id", "status", "response_text", F.from_json("response_text", PLAIN_PAYLOAD).alias("typed"))
            .withColumn("is_plain", _is_plain())
            .withColumn("json", F.when(~F.col("is_plain"), F.try_parse_json("response_text")))
            .select("document_id", F.inline(either)))
    return rows.select("document_id", "kind", "pos", "reason", normalize_name(F.col("name")).alias("title"),
                       *[normalize_name(F.col(n)).alias(n) for n in ("type", "source", "target")], "description", "weight", "text_prefix")


def _usable(rows: DataFrame, kind: str) -> DataFrame:
    found = rows if "kind" in rows.columns else elements(rows)
    return found.where((F.col("kind") == kind) & F.col("reason").isNull())


def entity_mentions(parsed: DataFrame) -> DataFrame:
    """The usable entities of ``elements`` (or of parsed results), position kept for ordering."""
    return _usable(parsed, "entity").where(F.col("title") != "").select(
        "document_id", "pos", "title", "type", "description")


def relationship_mentions(parsed: DataFrame) -> DataFrame:
    """P5: the usable relationships of ``elements`` (or of parsed results)."""
    return _usable(parsed, "relationship").where((F.col("source") != "") & (F.col("target") != "")).select(
        "document_id", "pos", "source", "target", "description", "weight")


def element_quarantine(rows: DataFrame) -> DataFrame:
    """Q11: the elements that are not usable, in the columns of ``model.quarantine``."""
    return rows.where(F.col("reason").isNotNull()).select(
        "document_id", F.concat_ws(" ", "kind", "pos").alias("part"), "reason", "text_prefix")


def _merge(mentions: DataFrame, key: list[str]) -> DataFrame:
    """One row per key from its mentions in order of document and position (Q16); ``descriptions`` only of keys with more than one."""
    listed = mentions.repartition(*key).groupBy(*key).agg(
        F.array_sort(F.collect_list(F.struct("document_id", "pos", "description"))).alias("d"))
    return listed.select(
        *key, F.size("d").cast("bigint").alias("n_descriptions"), F.col("d")[0]["description"].alias("first_description"),
        F.array_compact(F.array_distinct(F.col("d.document_id"))).alias("document_ids"),
        F.when(F.size("d") > 1, F.col("d.description")).alias("descriptions"))


#: Binary digits of weights that share one integer sum; a double has 53, so terms stay below 2^63.
LIMB = 8


def _times_two_to(c: Column, n: Column) -> Column:
    """``c * 2^n`` in two steps, as 2^n alone may leave the range of doubles."""
    half = F.floor(n / 2)
    return c * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), n - half)


def mean_weights(mentions: DataFrame, key: list[str]) -> DataFrame:
    """A4: mean weight per key over the whole range of finite doubles, whatever the order of rows.

    A weight is an integer times a power of two. Weights whose exponents share ``LIMB`` digits are summed as integers,
    exactly, one row per key and such limb (262 at most, one or two in practice); the limbs of a key are then
    added from the largest down. Both groupings end on the key, as the merge does, so their join needs no shuffle.
    """
    w = F.col("weight")
    limb = F.when(w == 0, F.lit(0)).otherwise(F.floor(F.log2(F.abs(w)) / LIMB)).cast("int")
    units = _times_two_to(w, F.lit(53) - F.col("limb") * LIMB).cast("bigint").cast("decimal(28,0)")
    sums = (mentions.withColumn("limb", limb).withColumn("units", units).groupBy(*key, "limb")
            .agg(F.sum("units").alias("units"), F.count(F.lit(1)).alias("n")))
    per_key = sums.groupBy(*key).agg(F.sum("n").alias("n"), F.sort_array(
        F.collect_list(F.struct("limb", "units")), asc=False).alias("limbs"))
    share = F.transform("limbs", lambda x: _times_two_to(x["units"].cast("double") / F.col("n"), x["limb"] * LIMB - F.lit(53)))
    return per_key.select(*key, F.aggregate(share, F.lit(0.0), lambda a, x: a + x).alias("weight"))


def merge_entities(mentions: DataFrame) -> DataFrame:
    """(title, type) -> n_descriptions, first_description, document_ids, descriptions."""
    return _merge(mentions, ENTITY_KEY)


def merge_relationships(mentions: DataFrame) -> DataFrame:
    """Ordered (source, target) -> counts, first description, mean weight."""
    return _merge(mentions, REL_KEY).join(mean_weights(mentions, REL_KEY), REL_KEY)


# ---------------------------------------------------------------- M5 summarisation


def _descriptions(merged: DataFrame, key: list[str]) -> DataFrame:
    """P6 + Q16: ordered description list, only for keys with more than one."""
    return merged.where(F.col("n_descriptions") > 1).select(*key, "descriptions")


def entity_summary_prompt(name, etype, descriptions) -> F.Column:
    """F14."""
    a, b, c = P.ENTITY_SUMMARY_PARTS
    return F.concat(F.lit(a), name, F.lit(b), etype, F.lit(c), numbered_lines(descriptions),
                    F.lit(P.SUMMARY_PROMPT_TAIL))


def relationship_summary_prompt(source, target, descriptions) -> F.Column:
    """F15."""
    a, b, c = P.RELATIONSHIP_SUMMARY_PARTS
    return F.concat(F.lit(a), source, F.lit(b), target, F.lit(c), numbered_lines(descriptions),
                    F.lit(P.SUMMARY_PROMPT_TAIL))


SUMMARY_KEYS = ["entity_or_rel_key", "kind", "a", "b"]


def summary_requests(ent_mentions: DataFrame, ent_merged: DataFrame,
                     rel_mentions: DataFrame, rel_merged: DataFrame,
                     cfg: ModelConfig) -> DataFrame:
    """Entity and relationship summary requests in one table.

    The string key ``entity::N::T`` is only a pass-through label (F11); joins use the
    separate (kind, a, b) columns, so a name containing ``::`` stays unambiguous (Q4).
    The merged rows carry the descriptions, so the mentions are not read again.
    """
    gen = M.generation_config(cfg, P.SUMMARIZATION_RESPONSE_SCHEMA)
    e = _descriptions(ent_merged, ENTITY_KEY).select(
        composite_key("entity", "title", "type").alias("entity_or_rel_key"),
        F.lit("entity").alias("kind"), F.col("title").alias("a"), F.col("type").alias("b"),
        entity_summary_prompt(F.col("title"), F.col("type"), F.col("descriptions"))
        .alias("prompt"))
    r = _descriptions(rel_merged, REL_KEY).select(
        composite_key("rel", "source", "target").alias("entity_or_rel_key"),
        F.lit("rel").alias("kind"), F.col("source").alias("a"), F.col("target").alias("b"),
        relationship_summary_prompt(F.col("source"), F.col("target"), F.col("descriptions"))
        .alias("prompt"))
    return e.unionByName(r).select(
        *SUMMARY_KEYS,
        M.request_json("prompt", gen, P.SUMMARIZATION_SYSTEM_INSTRUCTION).alias("request"))


def parse_summaries(results: DataFrame) -> DataFrame:
    """A11 + Q5: one summary per (kind, a, b); among duplicates the largest response wins."""
    parsed = M.parse_results(results, SUMMARY_KEYS, SUMMARY_PAYLOAD)
    good = parsed.where(F.col("reason").isNull() & F.col("payload.description").isNotNull())
    return good.groupBy("kind", "a", "b").agg(
        F.max_by(F.col("payload.description"), F.col("response_text")).alias("summary"))


# ---------------------------------------------------------------- M6 raw tables


def _with_summary(merged: DataFrame, summaries: DataFrame, kind: str, key: list[str]) -> DataFrame:
    """Merged rows with their summaries; keys with one description are never asked for (P6) and cross no shuffle."""
    s = summaries.where(F.col("kind") == kind).select(*[F.col(a).alias(n) for a, n in zip(("a", "b"), key)], "summary")
    several = F.col("n_descriptions") > 1
    return merged.where(several).join(s, key, "left").unionByName(
        merged.where(~several).withColumn("summary", F.lit(None).cast("string")))


def entities_raw(ent_merged: DataFrame, summaries: DataFrame | None) -> DataFrame:
    """J3 + F23: final description = summary, else first description, else ""."""
    df = ent_merged
    if summaries is not None:
        df = _with_summary(df, summaries, "entity", ENTITY_KEY)
    else:
        df = df.withColumn("summary", F.lit(None).cast("string"))
    return df.select(
        stable_id("entity", "title", "type").alias("id"), "title", "type",
        F.coalesce("summary", "first_description", F.lit("")).alias("description"),
        "document_ids")


def relationships_raw(rel_merged: DataFrame, summaries: DataFrame | None) -> DataFrame:
    df = rel_merged
    if summaries is not None:
        df = _with_summary(df, summaries, "rel", REL_KEY)
    else:
        df = df.withColumn("summary", F.lit(None).cast("string"))
    return df.select(
        stable_id("rel", "source", "target").alias("id"), "source", "target",
        F.coalesce("summary", "first_description", F.lit("")).alias("description"),
        F.col("weight").cast("double").alias("weight"), "document_ids")
