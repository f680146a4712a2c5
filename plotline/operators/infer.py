"""Routing, prompts, batch model runs with resume, and the domain classifier
(P17-P20, J8, J9, K6, M1, M2).

The model itself is the caller's: a function ``list[str] -> list[str]``.
It runs in ``mapInPandas`` over Arrow batches, only for rows that need it:
rows routed elsewhere (class ``Other``, pass-through languages) and rows
already finished never reach Python.
"""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plotline.functions import labels as L
from plotline.operators.joins import spread
from plotline.session import stored

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's prompts.
# ---------------------------------------------------------------------------
PROMPT_HEAD = (
    "In the following text, identify the core narrative that aligns with the author's perspective. \n"
    'Classify it based on the options in the list below. If the narrative in the text fall outside the list, '
    'answer "Other".\n'
    "\n"
    "### Options List (Narratives and subnarratives)\n"
)
PROMPT_TEXT_HEAD = "\n\n### Text\n             \n"
PROMPT_TAIL_WAR = (
    "\n\nProvide only the **most** relevant narratives that best fit the text's intent. \n"
    "If multiple narratives are equally significant, include them all.\n"
    "Answer **only** with the classifications and always include narratives and subnarratives."
)
PROMPT_TAIL_CLIMATE = (
    "\n\nProvide only the most relevant narratives that best fit the text's intent. \n"
    "If multiple narratives are equally significant, include them all.\n"
    "Answer **only** with the classifications and always include narratives and subnarratives."
)
NO_MODEL_ANSWER = "OTHEROTHER"
TRANSLATE_HEAD = (
    "Translate the following text into English. Be as precise as possible in retaining the information "
    "conveyed.\n\n"
)
PASS_THROUGH_LANGUAGES = ("EN", "HI")
# class id -> (theme long name, prompt tail)
PROMPT_CLASSES = {
    0: (L.THEME_NAMES["URW"], PROMPT_TAIL_WAR),
    1: (L.THEME_NAMES["CC"], PROMPT_TAIL_CLIMATE),
}


def option_lists(taxonomy: DataFrame, order: str | None = None) -> DataFrame:
    """``theme, options``: per theme, narratives each followed by ``- sub``
    lines (``Other`` last), blocks separated by a blank line. Ordered by
    ``order`` when given (e.g. outline position), else by name."""
    t = taxonomy.select(
        "theme",
        "narrative",
        "subnarrative",
        (F.col(order) if order else F.lit(0)).alias("__o"),
    )
    subs = t.groupBy("theme", "narrative").agg(
        F.array_sort(
            F.collect_set(
                F.struct(
                    (F.col("subnarrative") == "Other").alias("is_other"),
                    F.col("__o").alias("o"),
                    F.col("subnarrative").alias("s"),
                )
            )
        ).alias("subs"),
        F.min("__o").alias("__no"),
    )
    block = F.concat(
        F.col("narrative"), F.lit("\n"), F.array_join(F.transform("subs", lambda x: F.concat(F.lit("- "), x["s"])), "\n")
    )
    blocks = subs.select("theme", F.struct(F.col("__no").alias("o"), F.col("narrative").alias("n"), block.alias("b")).alias("blk"))
    return blocks.groupBy("theme").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("blk")), lambda x: x["b"]), "\n\n").alias("options")
    )


def prompt_templates(taxonomy: DataFrame, order: str | None = None) -> DataFrame:
    """``class_id, head, tail``: the text goes between head and tail."""
    spark = taxonomy.sparkSession
    classes = spark.createDataFrame(
        [(cid, theme, tail) for cid, (theme, tail) in PROMPT_CLASSES.items()],
        "class_id int, theme string, tail string",
    )
    opts = option_lists(taxonomy, order)
    return classes.join(opts, "theme", "left").select(
        "class_id",
        F.concat(F.lit(PROMPT_HEAD), F.coalesce(F.col("options"), F.lit("")), F.lit(PROMPT_TEXT_HEAD)).alias("head"),
        "tail",
    )


def route_prompts(
    docs: DataFrame,
    taxonomy: DataFrame,
    text_col: str = "content",
    class_col: str = "p_domains",
    order: str | None = None,
) -> DataFrame:
    """``prompt`` per row; classes without a template get null (they
    take the fixed answer ``OTHEROTHER`` and never reach the model).

    The templates, a row for each class, are broadcast whatever their size: every
    prompt holds one of them anyway, while texts shuffled by class would meet in as
    many tasks as there are classes."""
    tpl = prompt_templates(taxonomy, order)
    docs = spread(docs)
    j = docs.join(F.broadcast(tpl), docs[class_col] == tpl["class_id"], "left")
    prompt = F.when(F.col("head").isNotNull(), F.concat(F.col("head"), F.col(text_col), F.col("tail")))
    return j.select(*[docs[c] for c in docs.columns], prompt.alias("prompt"))


def translation_prompt(text) -> F.Column:
    """P18."""
    c = F.col(text) if isinstance(text, str) else text
    return F.concat(F.lit(TRANSLATE_HEAD), c)


def pending(df: DataFrame, finished: DataFrame | None, id_col: str) -> DataFrame:
    """Rows whose id has no finished result yet."""
    if finished is None:
        return df
    return df.join(finished.select(id_col).distinct(), id_col, "left_anti")


def _kept(key: str, load: Callable):
    """What ``load`` returns, once per Python worker: kept in the worker's modules,
    which outlive a task (the functions of this package do not: they are pickled)."""
    models = sys.modules.setdefault("_plotline_models", types.ModuleType("_plotline_models")).__dict__
    if key not in models:
        models[key] = load()
    return models[key]


def _answers(fn: Callable[[list[str]], list[str]], texts: list[str], errors: bool) -> list[tuple[str | None, str | None]]:
    """(answer, error) of each text. With ``errors``, a call that fails is repeated
    text by text, and a text that fails alone has its error for an answer."""
    try:
        out = list(fn(texts))
        if len(out) != len(texts):
            raise ValueError("model returned a different number of answers")
        return [(x, None) for x in out]
    except Exception as e:  # noqa: BLE001 - whatever the caller's model raises
        if not errors:
            raise
        if len(texts) == 1:
            return [(None, f"{type(e).__name__}: {e}")]
        return [_answers(fn, [t], errors)[0] for t in texts]


def apply_model(
    df: DataFrame,
    fn: Callable[[list[str]], list[str]] | None,
    id_col: str,
    input_col: str,
    output_col: str,
    batch_size: int = 16,
    load: Callable[[], Callable[[list[str]], list[str]]] | None = None,
    errors: bool = False,
) -> DataFrame:
    """M2: ``id, output`` from ``fn`` over Arrow batches of ``input_col``;
    ``fn`` sees ``batch_size`` texts of like length at a time. ``load`` (instead of
    ``fn``) makes the function, once in each Python worker. With ``errors`` there is
    a column ``error``: null, or why the row has no output; else a failing call
    fails the job."""
    id_type = dict(df.dtypes)[id_col]
    schema = f"{id_col} {id_type}, {output_col} string" + (", error string" if errors else "")
    key = uuid.uuid4().hex

    def run(batches):
        model = fn
        for pdf in batches:
            if model is None:
                model = _kept(key, load)
            ids, texts = pdf[id_col].tolist(), pdf[input_col].tolist()
            outs: list = [None] * len(texts)
            order = sorted(range(len(texts)), key=lambda i: len(texts[i] or ""))
            for i in range(0, len(order), batch_size):
                chunk = order[i : i + batch_size]
                for k, answer in zip(chunk, _answers(model, [texts[k] for k in chunk], errors)):
                    outs[k] = answer
            if outs:
                table = {id_col: ids, output_col: [x for x, _ in outs]}
                yield pd.DataFrame(table | ({"error": [e for _, e in outs]} if errors else {}))

    return spread(df.select(id_col, input_col)).mapInPandas(run, schema)


def answer_routed(
    prompts: DataFrame,
    fn: Callable[[list[str]], list[str]],
    id_col: str,
    output_col: str = "gpt_output",
    finished: DataFrame | None = None,
) -> DataFrame:
    """Model answers for routed prompts: null prompt -> ``OTHEROTHER``
    without a call; finished ids are skipped (J8). Returns ``id, output``."""
    todo = pending(prompts, finished, id_col)
    fixed = todo.where(F.col("prompt").isNull()).select(id_col, F.lit(NO_MODEL_ANSWER).alias(output_col))
    asked = apply_model(todo.where(F.col("prompt").isNotNull()), fn, id_col, "prompt", output_col)
    return fixed.unionByName(asked)


def translate(
    df: DataFrame,
    fn: Callable[[list[str]], list[str]],
    id_col: str,
    text_col: str = "content",
    lang_col: str = "language",
    output_col: str = "en_content",
    keep=PASS_THROUGH_LANGUAGES,
    finished: DataFrame | None = None,
) -> DataFrame:
    """``id, en_content``; ``keep`` languages pass through
    (Q12), finished ids are skipped, the rest go to ``fn`` as prompts."""
    todo = pending(df, finished, id_col)
    passthru = F.upper(F.col(lang_col)).isin(list(keep))
    kept = todo.where(passthru).select(id_col, F.col(text_col).alias(output_col))
    asked = todo.where(~passthru | F.col(lang_col).isNull()).select(
        id_col, translation_prompt(text_col).alias("__prompt")
    )
    return kept.unionByName(apply_model(asked, fn, id_col, "__prompt", output_col))


def length_stub(prompts: list[str]) -> list[str]:
    """Deterministic stand-in model: answers with the prompt length."""
    return [f"len={len(p)}" for p in prompts]


# ---------------------------------------------------------------------------
# M1: out-of-fold domain classifier
# ---------------------------------------------------------------------------

def out_of_fold_predictions(
    df: DataFrame,
    text_col: str,
    label_col: str,
    id_col: str,
    fold_col: str = "fold",
    smoothing: float = 1.0,
) -> DataFrame:
    """M1 + J9: ``df`` with ``p_domains``, the class a multinomial naive Bayes
    text model, fitted on the other folds, gives each row. Ids are unique;
    rows without a class are predicted but not fitted on.

    No model per fold: (fold, class, token) counts are summed once, and the
    training counts of a fold are the totals minus its own. A token adds
    n * ln((count + s) / s) in every class whose training rows have it; the
    rest of the posterior depends only on class, fold and text length. Ties
    (after rounding to 9 places) go to the smaller class."""
    tokens = F.filter(F.split(F.lower(F.coalesce(F.col(text_col), F.lit(""))), r"(?U)\W+"), lambda x: x != "")
    rows = df.select(F.col(id_col).alias("__id"), F.col(fold_col).alias("__f"), F.col(label_col).alias("__c"), F.sort_array(tokens).alias("__w"))
    # words are counted inside their row: sorted, a word is a run, known by its first place
    first = lambda i: F.get("__w", i).isNotNull() & ((i == 0) | (F.get("__w", i) != F.get("__w", i - 1)))
    rows = rows.withColumn("__at", F.filter(F.sequence(F.lit(0), F.greatest(F.size("__w") - 1, F.lit(0))), first))
    run = lambda i, k: F.struct(F.get("__w", i).alias("__t"), (F.coalesce(F.get("__at", k + 1), F.size("__w")) - i).cast("long").alias("__n"))
    rows = rows.select("__id", "__f", "__c", F.size("__w").alias("__len"), F.transform("__at", run).alias("__words"))
    rows = stored(rows, "tokens")  # read four times: folds and words are made once
    words = rows.select("__id", "__f", "__c", F.inline("__words"))
    known = words.where(F.col("__c").isNotNull())
    own = known.groupBy("__f", "__c", "__t").agg(F.sum("__n").alias("__own"))
    total = own.groupBy("__c", "__t").agg(F.sum("__own").alias("__all"), F.collect_list(F.struct("__f", "__own")).alias("__by"))
    # rows and words of every class, in all and by fold: a few rows, kept as one array value
    classes = rows.where(F.col("__c").isNotNull()).groupBy("__c", "__f").agg(
        F.count("*").alias("__d"), F.sum("__len").alias("__m")
    )
    per_class = classes.groupBy("__c").agg(
        F.sum("__d").alias("__d"), F.sum("__m").alias("__m"), F.map_from_entries(F.collect_list(F.struct("__f", F.struct("__d", "__m")))).alias("__by")
    )
    every = per_class.select(F.collect_list(F.struct("__c", "__d", "__m", "__by"))).scalar()
    size = own.select(F.count_distinct("__t")).scalar()
    base = rows.select("__id", "__f", "__len", F.explode(every).alias("__x"))
    mine = F.try_element_at(F.col("__x.__by"), F.col("__f"))
    docs = F.col("__x.__d") - F.coalesce(mine["__d"], F.lit(0))
    mass = F.col("__x.__m") - F.coalesce(mine["__m"], F.lit(0)) + F.lit(smoothing) * size
    base = base.where(docs > 0).select(
        "__id",
        F.col("__x.__c").alias("__c"),
        (F.log(docs) + F.col("__len") * (F.log(F.lit(smoothing)) - F.log(mass))).alias("__s"),
    )
    gain = total.select("__c", "__t", "__all", F.map_from_entries("__by").alias("__by"))
    hits = words.select("__id", "__f", "__t", "__n").join(gain, "__t").select(
        "__id",
        "__c",
        (F.col("__n") * F.log((F.col("__all") - F.coalesce(F.try_element_at("__by", F.col("__f")), F.lit(0)) + F.lit(smoothing)) / F.lit(smoothing))).alias("__s"),
    )
    hits = hits.where("__s > 0").groupBy("__id", "__c").agg(F.sum("__s").alias("__g"))
    best = (
        base.join(hits, ["__id", "__c"], "left")
        .withColumn("__s", F.round(F.col("__s") + F.coalesce("__g", F.lit(0.0)), 9))
        .groupBy("__id")
        .agg(F.min(F.struct((-F.col("__s")).alias("s"), F.col("__c").alias("c")))["c"].alias("p_domains"))
    )
    return df.join(best, df[id_col] == best["__id"], "left").drop("__id")


def top_rank(df: DataFrame, part: list[str], order: list, n: int, rank_col: str | None = None) -> DataFrame:
    """L1 / L2: first ``n`` rows per group by ``order`` (a top-k report; the
    window runs per group of an already aggregated table). ``rank_col``
    keeps the rank."""
    col = rank_col or "__rn"
    w = Window.partitionBy(*part).orderBy(*order)
    out = df.withColumn(col, F.row_number().over(w)).where(F.col(col) <= n)
    return out if rank_col else out.drop(col)
