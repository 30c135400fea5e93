"""Export layouts, system prompts and chat templates: projections only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed as X
from ..functions.text import c, first_filled
from .temporal import bounded


def _fill(layout: str, **parts: Column | str) -> Column:
    """A layout with {name} places as one concat."""
    import re

    out = []
    for piece in re.split(r"(\{\w+\})", layout):
        if piece[:1] == "{" and piece[1:-1] in parts:
            p = parts[piece[1:-1]]
            out.append(F.lit(p) if isinstance(p, str) else p)
        elif piece:
            out.append(F.lit(piece))
    return F.concat(*out) if out else F.lit("")


def _qa(df: DataFrame) -> tuple[Column, Column]:
    return first_filled(*[n for n in ("question", "instruction") if n in df.columns]), first_filled(*[n for n in ("answer", "output") if n in df.columns])


def formatted(df: DataFrame, kind: str = "chat", system: str = X.PROMPT_EXPORT, fields: tuple[str, str, str] = ("instruction", "input", "output"), source: bool = False, perspective: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """messages (chat), the three fields (instruction), question and answer (simple), or the rows as they are."""
    q, a = _qa(df)
    message = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    if kind == "chat":
        out = [F.array(message("system", F.lit(system)), message("user", q), message("assistant", a)).alias("messages")]
    elif kind == "instruction":
        out = [q.alias(fields[0]), (F.coalesce(F.col("input"), F.lit("")) if "input" in df.columns else F.lit("")).alias(fields[1]), a.alias(fields[2])]
    elif kind == "simple":
        out = [q.alias("question"), a.alias("answer")]
    else:
        out = [F.col(n) for n in df.columns if n not in ("source", "perspective") or not source]
    if source:
        out.append(first_filled(*[n for n in ("source_doc", "source") if n in df.columns]).alias("source"))
        if perspective:
            out.append((F.coalesce(F.col("perspective"), F.lit("")) if "perspective" in df.columns else F.lit("")).alias("perspective"))
    return df.select(*keep, *out)


def cited_documents(text: Column | str) -> Column:
    """array of struct(doc_type, doc_id): the first place of each id, by pattern and then in the order of the text."""
    t = F.coalesce(c(text), F.lit(""))

    def of(pattern: str, kind: str) -> Column:
        return F.transform(F.regexp_extract_all(t, F.lit(f"(?iuU){pattern}"), F.lit(1)), lambda x: F.struct(F.lit(kind).alias("doc_type"), x.alias("doc_id")))

    found = F.concat(*[of(p, kind) for p, kind in X.CITED_DOCUMENTS])
    ids = F.transform(found, lambda y: y["doc_id"])
    return F.filter(found, lambda x, i: F.array_position(ids, x["doc_id"]) == i + 1)


def with_system_prompt(df: DataFrame, registry: DataFrame | None = None, date: str = "01/12/2025", mode: str = "specific", answer: str = "answer") -> DataFrame:
    """df with cited_documents and system_prompt: minimal, general, or naming up to three cited documents."""
    df = df.withColumn("cited_documents", cited_documents(answer))
    base = X.PROMPT_BASE.format(date=date)
    if mode == "minimal":
        return df.withColumn("system_prompt", F.lit(X.PROMPT_MINIMAL))
    general = F.lit(base + X.PROMPT_GENERAL)
    if mode == "general":
        return df.withColumn("system_prompt", general)
    if registry is not None:  # one broadcast row
        one = bounded(registry).groupBy().agg(F.map_from_entries(F.collect_list(F.struct("id", F.struct("type", "status")))).alias("_known"))
        df = df.crossJoin(F.broadcast(one))
    else:
        df = df.withColumn("_known", F.lit(None).cast("map<string,struct<type:string,status:string>>"))

    def line(x):
        known = F.try_element_at(F.col("_known"), x["doc_id"])
        return F.coalesce(F.concat(F.lit("- "), known["type"], F.lit(" số "), x["doc_id"], F.lit(" ("), known["status"], F.lit(")")), F.concat(F.lit("- "), x["doc_type"], F.lit(" số "), x["doc_id"]))

    listed = F.array_join(F.transform(F.slice("cited_documents", 1, 3), line), "\n")
    specific = F.concat(F.lit(base + X.PROMPT_SPECIFIC[0]), listed, F.lit(X.PROMPT_SPECIFIC[1]))
    return df.withColumn("system_prompt", F.when(F.size("cited_documents") > 0, specific).otherwise(general)).drop("_known")


def laid_out(df: DataFrame, layout: str = "chat", to: str = "formatted_text") -> DataFrame:
    """Question and answer under system_prompt as one text; unknown layouts are plain."""
    q, a = _qa(df)
    return df.withColumn(to, _fill(X.QA_LAYOUTS.get(layout, X.QA_LAYOUTS["plain"]), system=F.col("system_prompt"), user=q, assistant=a))


def chat_text(question: Column | str, answer: Column | str, template: str = "vistral", system: str = X.PROMPT_TOKENS) -> Column:
    before, after = X.CHAT_TEMPLATES[template]
    return _fill(before + "{assistant}" + after, system=system, user=c(question), assistant=c(answer))


def prompt_text(question: Column | str, template: str = "vistral", system: str = X.PROMPT_TOKENS) -> Column:
    """What stands before the answer."""
    return _fill(X.CHAT_TEMPLATES[template][0], system=system, user=c(question))


def topic_prompt(topic: Column | str, date: str, topics: dict[str, str] = X.TOPIC_PROMPTS) -> Column:
    """The system prompt of a topic (the one of "default" for others) with {date} filled in."""
    known = F.create_map(*[x for k, v in topics.items() for x in (F.lit(k), F.lit(v.replace("{date}", date)))])
    return F.coalesce(F.try_element_at(known, c(topic)), F.lit(topics["default"].replace("{date}", date)))


def merged(splits: DataFrame) -> DataFrame:
    """All splits, in the order train, validation, test."""
    place = F.when(F.col("split") == "train", 0).when(F.col("split") == "validation", 1).otherwise(2)
    return splits.withColumn("_place", place).orderBy("_place", *(["seq"] if "seq" in splits.columns else [])).drop("_place")


def write_splits(df: DataFrame, path: str, kind: str = "json") -> None:
    df.write.mode("overwrite").partitionBy("split").option("ignoreNullFields", "false").format(kind).save(path)
