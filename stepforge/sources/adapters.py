"""Views over the given tables in the shapes the operators expect.

``steps`` from events, ``samples`` from documents and labels, ``conversation_sizes`` from
conversations, ``hashes`` from documents, ``frames`` from embeddings, and file
listings from pages.  Each definition has an equal SQL text in ``plans.sqlviews``.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from stepforge import domains as D
from stepforge.functions import regions as R
from stepforge.functions import text as T
from stepforge.operators import skew
from stepforge.operators.trajectory import LOOKAHEAD, PAYLOAD

TASKS = [
    "Open Gmail and reply to the latest message",
    "Search the browser for all flight options and compare prices",
    "Fill in the registration form and submit it",
    "Save the document to the work folder",
    "Quit",
    "Translate the Urdu settings page on the phone app",
    "Delete the file, then undo and restore it",
    "Scroll to the payment section and confirm the purchase",
]
SAMPLE_ACTIONS = ["click", "type", "key", "scroll", "right_click", "done", "double_click", "hover"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(index, values: list[str]):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recorded steps: a session is one user in one week, ordered by time."""
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    action = (
        F.when(F.col("event_type") == "click", "click")
        .when(F.col("event_type") == "view", "scroll")
        .when(F.col("event_type") == "signup", "type")
        .when(F.col("event_type") == "purchase", "key")
        .otherwise("fail")
    )
    week = F.date_format(F.date_trunc("week", "ts"), "yyyy-MM-dd")
    clicked = F.col("event_type") == "click"
    return e.select(
        F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("_"), week).alias("session_id"),
        "event_id",
        "ts",
        "user_id",
        F.col("event_id").alias("step_index"),
        k.alias("k"),
        action.alias("action_type"),
        F.when(clicked, F.array(F.col("value") / 200.0, k / 100.0)).alias("coordinates"),
        clicked.alias("has_coordinates"),
        F.when(F.col("event_type") == "signup", k.cast("string")).alias("text"),
        _pick(F.col("user_id") % 8, TASKS).alias("task"),
    )


def placed_steps(spark: SparkSession, sf_dir: str, lookahead: int = LOOKAHEAD) -> DataFrame:
    """Steps with their place in the session and the steps that follow."""
    return skew.in_order(
        steps(spark, sf_dir), ["ts", "event_id"], PAYLOAD, lookahead
    )


def recorded_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Steps as recorded JSON lines, among them blank, broken and malformed ones."""
    s = steps(spark, sf_dir)
    k, c = F.col("k"), F.col("coordinates")
    number = F.col("step_index").cast("string")
    index = F.when(k % 47 == 0, "").otherwise(
        F.concat(
            F.lit('"step_index": '),
            F.when(k % 43 == 0, F.concat(F.lit('"'), number, F.lit('"'))).otherwise(number), F.lit(", "),
        )
    )
    kind = F.when(k % 2 == 0, F.concat(F.upper("action_type"), F.lit(" "))).otherwise(F.col("action_type"))
    point = F.when(
        c.isNotNull(),
        F.concat(F.lit(', "coordinates": ["'), c[0].cast("string"), F.lit('", '), c[1].cast("string"), F.lit(", 9]")),
    ).otherwise("")
    typed = F.when(
        F.col("text").isNotNull(), F.concat(F.lit(', "text": '), F.col("text"))
    ).otherwise("")
    action = (
        F.when(k % 37 == 0, F.lit('"x"'))
        .when(k % 41 == 0, F.lit("{}"))
        .otherwise(F.concat(F.lit('{"type": "'), kind, F.lit('"'), point, typed, F.lit(', "description": "step '), number, F.lit('"}')))
    )
    task = F.when(k % 31 == 0, F.lit("  ")).otherwise(F.col("task"))
    document = F.concat(
        F.lit("{"), index, F.lit('"task": "'), task, F.lit('", "session_id": "'), F.col("session_id"),
        F.lit('", "action": '), action, F.lit(', "screenshot_path": "/shots/'), number,
        F.lit('.png", "ocr_text": "k='), k.cast("string"), F.lit('", "timestamp": "2024"}'),
    )
    value = (
        F.when(k % 23 == 0, "").when(k % 29 == 0, "{broken").when(k % 53 == 0, "[1, 2]").otherwise(document)
    )
    return s.select(
        value.alias("value"),
        F.concat(F.lit("session_"), F.col("session_id"), F.lit(".jsonl")).alias("source_file"),
        (F.col("event_id") + 1).alias("line_number"),
        "event_id", "action_type", "user_id",
    )


def sample_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The samples as recorded lines of one long file, in document order."""
    s = samples(spark, sf_dir)
    action = F.struct(
        F.col("action_type").alias("type"), "coordinates", "text", "key", "description"
    )
    document = F.to_json(
        F.struct("step_index", "task", "session_id", action.alias("action"), "screenshot_path",
                 F.col("ocr_text_raw").alias("ocr_text"), F.lit("2024").alias("timestamp"))
    )
    return s.select(
        document.alias("value"), F.lit("recordings.jsonl").alias("source_file"),
        (F.col("doc_id") + 1).alias("line_number"),
    )


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recorded annotator answers for every document: (doc_id, provider, raw_response).

    The first provider answers with fenced JSON, broken when the document is toxic;
    the second with a preamble, and only for good documents; the third always well.
    Documents without labels get some by their number; for a third of them every
    provider fails.
    """
    j = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    silent = F.col("quality").isNull() & (F.col("doc_id") % 3 == 0)
    j = (
        j.withColumn("silent", silent)
        .withColumn("toxic", F.coalesce("toxic", F.col("doc_id") % 2))
        .withColumn("quality", F.coalesce("quality", (F.col("doc_id") % 5 == 0).cast("int")))
    )
    body = F.concat(
        F.lit('{"reasoning": '), T.json_string(F.replace(F.replace("text", F.lit("{"), F.lit("(")), F.lit("}"), F.lit(")"))),
        F.lit(', "intent": "Serve item '), F.col("doc_id").cast("string"), F.lit('"}'),
    )
    j = j.withColumn("body", body)  # in three answers, made once
    body = F.col("body")
    answers = F.array(
        F.struct(
            F.lit("groq").alias("provider"),
            F.when(F.col("toxic") == 1, F.lit("no json here"))
            .otherwise(F.concat(F.lit("```json\n"), body, F.lit("\n```"))).alias("raw_response"),
        ),
        F.struct(
            F.lit("google").alias("provider"),
            F.when(F.col("quality") == 1, F.concat(F.lit("Sure, here it is: "), body))
            .otherwise(F.lit("")).alias("raw_response"),
        ),
        F.struct(F.lit("openrouter").alias("provider"), body.alias("raw_response")),
    )
    given = j.select("doc_id", "silent", F.explode(answers).alias("a"))
    return given.select(
        "doc_id", "a.provider", F.when(F.col("silent"), F.lit("no answer")).otherwise(F.col("a.raw_response")).alias("raw_response")
    )


def model_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as model answers with action blocks of every quality."""
    c = table(spark, sf_dir, "conversations")
    n = F.col("conv_id") + F.col("turn")
    point = F.concat(F.lit("["), (n % 13 / 10.0).cast("string"), F.lit(", 0.5]"))
    body = (
        F.when(n % 7 == 0, F.lit("not json"))
        .when(n % 7 == 1, F.lit('{"type": "fly"}'))
        .when(n % 7 == 2, F.lit('{"type": "click", "coordinates": [0.5]}'))
        .when(n % 7 == 3, F.lit('{"type": "type", "text": "hello", "amount": 2}'))
        .otherwise(F.concat(F.lit('\n{"type": "click",\n "coordinates": '), point, F.lit(', "description": "OK"}\n')))
    )
    block = F.when(F.col("role") == "system", F.lit("")).otherwise(
        F.concat(F.lit("<action>"), body, F.lit("</action>"), F.lit("<action>{}</action>"))
    )
    return c.select(
        "conv_id", "turn", "role",
        F.concat(F.lit("<think>\n"), F.col("text"), F.lit("\n</think>\n"), block).alias("output"),
    )


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Agent step history: a task is one user, steps numbered by event id."""
    s = steps(spark, sf_dir)
    return s.select(
        F.concat(F.lit("t"), F.col("user_id").cast("string")).alias("task_id"),
        "event_id",
        F.col("event_id").alias("step_index"),
        F.when(F.col("k") % 10 == 0, F.lit(None)).when(
            (F.col("action_type") == "key") & (F.col("k") % 3 == 0), "done"
        ).otherwise(F.col("action_type")).alias("action_type"),
        (F.col("k") % 4 != 0).alias("success"),
        F.when(F.col("k") % 7 == 0, F.concat(F.lit("error "), F.col("k").cast("string"))).alias("error"),
        F.when(F.col("k") % 5 != 0, F.concat(F.lit("/shots/"), F.col("event_id").cast("string"), F.lit(".png")))
        .otherwise("").alias("screenshot_path"),
        F.concat(F.lit("step at "), F.col("k").cast("string")).alias("description"),
        "task",
    )


def region_array(text, separator: str = "\n"):
    """Lines of a text as screen regions."""
    return F.transform(
        F.split(text, separator),
        lambda line, i: F.struct(
            line.alias("text"),
            F.array(
                (F.length(line) % 10) / 20.0,
                (i % 20) / 20.0,
                (F.length(line) % 10) / 20.0 + 0.3,
                (i % 20) / 20.0 + 0.04,
            ).alias("bbox"),
            ((F.length(line) % 50 + 50) / 100.0).alias("confidence"),
            F.lit("latin").alias("script"),
        ),
    )


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sample rows with regions, annotation and flags, one per document."""
    d = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    j = d.join(labels, "doc_id", "left")
    action = _pick(F.col("doc_id") % 8, SAMPLE_ACTIONS)
    grounded = F.col("action_type").isin(D.CLICK_FAMILY) & (F.col("doc_id") % 16 != 0)
    return (
        j.select(
            "doc_id",
            F.concat(F.lit("s_"), F.col("doc_id").cast("string")).alias("sample_id"),
            F.col("source").alias("session_id"),
            (F.col("doc_id") % 20).cast("int").alias("step_index"),
            F.lit("human_demo").alias("source_type"),
            _pick(F.floor(F.col("doc_id") / 3) % 8, TASKS).alias("task"),
            action.alias("action_type"),
            "n_chars",
            "text",
            "quality",
            "toxic",
            F.col("lang").alias("doc_lang"),
        )
        .withColumn(
            "coordinates",
            F.when(grounded, F.array((F.col("n_chars") % 1000) / 900.0, (F.col("doc_id") % 100) / 100.0)),
        )
        .withColumn("document", F.col("text"))
        .withColumn("text", F.when(F.col("action_type") == "type", F.get(F.split("document", "\n"), 0)))
        .withColumn("key", F.when(F.col("action_type") == "key", F.lit("ctrl+s")))
        .withColumn(
            "description",
            F.when(F.col("doc_id") % 11 == 0, "").otherwise(
                F.concat(F.lit("Use "), F.col("action_type"), F.lit(" on item "), F.col("doc_id").cast("string"))
            ),
        )
        .withColumn("ocr_text_raw", F.col("document"))
        .withColumn("screenshot_path", F.concat(F.lit("/shots/"), F.floor(F.col("doc_id") / 3).cast("string"), F.lit(".png")))
        .withColumn("regions", region_array(F.col("document")))
        .withColumn("n_regions", F.size("regions"))
        .withColumn("sha256", F.sha2("document", 256))
        .withColumn("reasoning", F.when(F.col("quality").isNotNull(), F.col("document")).otherwise(""))
        .withColumn("intent", F.when(F.col("quality") == 1, F.col("task")).otherwise(""))
        .withColumn("reasoning_verified", F.coalesce(F.col("quality") == 1, F.lit(False)))
        .withColumn("is_error_step", F.coalesce(F.col("toxic") == 1, F.lit(False)))
        .withColumn("tags", T.infer_tags(F.col("task"), F.col("action_type")))
    )


def screenshot_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as a file listing: path, length, content."""
    p = table(spark, sf_dir, "pages")
    return p.select(
        F.concat(F.lit("/shots/"), F.col("page_id").cast("string"), F.lit(".png")).alias("path"),
        F.octet_length("html").cast("long").alias("length"),
        F.encode("html", "utf-8").alias("content"),
    )


def screenshot_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listing with dimensions and variance as an image decoder would report them.

    Twenty-four neighbouring pages look alike: their hashes differ in at most five bits.
    """
    p = table(spark, sf_dir, "pages")
    page = F.col("page_id")
    readable = page % 13 != 0
    return p.select(
        F.concat(F.lit("/shots/"), page.cast("string"), F.lit(".png")).alias("path"),
        (F.octet_length("html").cast("long") * 4).alias("length"),
        F.when(readable, (380 + (page % 9) * 40).cast("int")).alias("width"),
        F.when(readable, (280 + (page % 7) * 40).cast("int")).alias("height"),
        F.when(readable, (page % 31) * 10.0).alias("variance"),
        F.sha2("html", 256).alias("file_sha"),
        F.concat(
            F.substring(F.sha2(F.concat(F.lit("family:"), F.floor(page / 24).cast("string")), 256), 1, 62),
            F.lpad(F.lower(F.hex(page % 24)), 2, "0"),
        ).alias("phash"),
    )


def page_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recognised regions per screenshot path: the pieces of a page between tags."""
    p = table(spark, sf_dir, "pages")
    return p.select(
        F.concat(F.lit("/shots/"), F.col("page_id").cast("string"), F.lit(".png")).alias("path"),
        region_array(F.col("html"), "<").alias("regions"),
    )


def conversation_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per conversation with its number of turns and images.

    Counted, not collected: a conversation of any length stays one small row.
    """
    c = table(spark, sf_dir, "conversations")
    return c.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n_turns"),
        F.count_if(F.col("role") == "assistant").alias("n_answers"),
    ).withColumn("n_images", F.when(F.col("conv_id") % 5 != 0, 1).otherwise(0))


@F.pandas_udf(StringType())
def sign_hash(word_lists: pd.Series) -> pd.Series:
    """256-bit sign hash of a word set: bit i is 1 when most word digests have it."""
    lengths = [len(tokens) for tokens in word_lists]
    if not sum(lengths):
        return pd.Series(["0" * 64] * len(lengths), dtype=object)
    codes, distinct = pd.factorize(np.concatenate([np.asarray(t, dtype=object) for t in word_lists]))
    digests = b"".join(hashlib.sha256(w.encode("utf-8")).digest() for w in distinct)
    votes = np.unpackbits(np.frombuffer(digests, dtype=np.uint8).reshape(-1, 32), axis=1).astype(np.int8) * 2 - 1
    ends = np.cumsum(lengths)
    hashes = [
        np.packbits(votes[codes[end - n:end]].sum(axis=0, dtype=np.int32) > 0).tobytes().hex()
        for n, end in zip(lengths, ends)
    ]
    return pd.Series(hashes, dtype=object)


def hashed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows for duplicate detection: id, ord, sha, phash, action, words, coordinates."""
    d = table(spark, sf_dir, "documents")
    tokens = T.words(F.lower("text"))
    return d.select(
        F.col("doc_id").cast("string").alias("id"),
        F.col("doc_id").alias("ord"),
        F.sha2("text", 256).alias("sha"),
        sign_hash(F.array_distinct(tokens)).alias("phash"),
        F.col("lang").alias("action"),
        F.array_sort(F.array_distinct(F.slice(tokens, 1, D.TASK_WORDS))).alias("words"),
        F.lit(None).cast("array<double>").alias("coordinates"),
    )


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as 8x8 three-channel frames of a session (= label), in vec_id order."""
    e = table(spark, sf_dir, "embeddings")
    level = lambda v: F.least(F.lit(255), F.greatest(F.lit(0), F.floor((v.cast("double") + 0.5) * 255).cast("int")))
    grey = F.transform("embedding", level)
    hex2 = lambda n: F.lpad(F.hex(n.cast("long")), 2, "0")
    pixels = F.array_join(
        F.transform(
            grey, lambda g, i: F.concat(hex2(g), hex2(255 - g), hex2((g + i * 3) % 256))
        ),
        "",
    )
    return e.select(
        "vec_id",
        F.concat(F.lit("s"), F.col("label").cast("string")).alias("session_id"),
        F.lit(8).alias("height"),
        F.lit(8).alias("width"),
        F.lit(3).alias("channels"),
        F.unhex(pixels).alias("data"),
    )


def retold_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings (even ids), each also moved by a third towards its successor (odd ids)."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    after = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("_next"))
    moved = F.zip_with("embedding", "_next", lambda a, b: a + 0.33 * b)
    return e.withColumn("vec_id", F.col("vec_id") * 2).unionByName(
        e.join(after, "vec_id").select((F.col("vec_id") * 2 + 1).alias("vec_id"), moved.alias("embedding"))
    )
