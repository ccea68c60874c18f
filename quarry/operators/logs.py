"""Conversation and response logs.

``flatten_responses`` turns free-form agent responses (JSON text) into one
display text with the precedence rules of the reference's formatter, written
as variant reads and higher-order array functions. An expression cannot recurse,
so it reads lists inside lists ``INLINE`` levels down. Responses with more
envelopes than that go level by level instead: the lists of one level are
exploded, those inside them form the next, smaller table, and the texts are
joined back from the deepest level up. Any depth is read, and no plan holds
more than one level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.partitioning import spread
from quarry.sources.tables import write_scratch

# Notices and the agent tag-line pattern of the response formatter.
EMPTY_OUTPUT_NOTICE = "The agent endpoint returned no output items (empty output list). response id="
METADATA_NOTICE = ("The agent endpoint returned no message text (only response metadata). "
                   "If this persists, check the endpoint task type and response shape. id=")
BENIGN_KEYS = ["id", "object", "model", "created", "created_at", "usage", "metadata", "served_model_name"]
OUTPUT_KEYS = ["output", "outputs", "predictions", "choices"]
NAME_TAG = r"(?U)^<name>\s*[\w-]+\s*</name>\s*$"
INLINE = 2
_ENVELOPES = r'"(?:outputs?|predictions)"\s*:'
_EDGES = r"(?U)^\s+|\s+$"


def _empty() -> Column:
    return F.array().cast("array<string>")


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` (a one-element transform acts as a let binding)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _strip(c: Column) -> Column:
    return F.regexp_replace(c, _EDGES, "")


def _kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def _is_str(v: Column) -> Column:
    return _kind(v) == "STRING"


def _is_obj(v: Column) -> Column:
    return _kind(v).startswith("OBJECT")


def _get(v: Column, key: str) -> Column:
    return F.try_variant_get(v, f"$.{key}", "variant")


def _arr(v: Column) -> Column:
    return F.when(_kind(v).startswith("ARRAY"), F.try_variant_get(v, "$", "array<variant>"))


def _str(v: Column) -> Column:
    return F.when(_is_str(v), F.try_variant_get(v, "$", "string"))


def _falsy(v: Column) -> Column:
    """Absent, null, false, zero or empty: what counts as missing in the response format."""
    return v.isNull() | F.is_variant_null(v) | F.to_json(v).isin('""', "0", "0.0", "false", "[]", "{}")


def _json(v: Column) -> Column:
    return F.to_json(v)


def _py_repr(v: Column) -> Column:
    """repr() of a JSON scalar: quoted for strings, as is otherwise."""
    return F.when(_is_str(v), F.concat(F.lit("'"), _str(v), F.lit("'"))).otherwise(_json(v))


def _item_parts(item: Column, depth: int) -> Column:
    def nested_parts():
        # First nested envelope (outputs, output, predictions) that yields text wins.
        lists = F.array(*[_arr(_get(item, key)) for key in ["outputs", "output", "predictions"]])
        subs = F.transform(lists, lambda nested: _list_text(nested, depth - 1))
        return _let(F.filter(subs, lambda x: x.isNotNull() & (_strip(x) != "")),
                    lambda ok: F.when(F.size(ok) > 0, F.array(_strip(ok[0]))).otherwise(_empty()))

    def by_type():
        typ = _str(_get(item, "type"))
        content = _get(item, "content")
        blocks = F.transform(_arr(content), lambda b: F.when(
            _is_obj(b) & _str(_get(b, "type")).isin("output_text", "text") & _is_str(_get(b, "text")),
            _strip(_str(_get(b, "text")))))
        block_parts = F.filter(blocks, lambda t: t.isNotNull() & (t != "") & ~t.rlike(NAME_TAG))
        message = _let(_strip(_str(content)), lambda cs: F.when(cs.isNotNull() & (cs != ""), F.array(cs))
                       .when(_arr(content).isNotNull(), block_parts).otherwise(_empty()))
        own = _let(_strip(_str(_get(item, "text"))), lambda t: F.when(
            t.isNotNull() & (t != "") & ~t.rlike(NAME_TAG), F.array(t)).otherwise(_empty()))
        return F.when(typ == "message", message).otherwise(own)

    if depth > 0:
        obj = _let(nested_parts(), lambda n: F.when(F.size(n) > 0, n).otherwise(by_type()))
    else:
        obj = by_type()
    return _let(_strip(_str(item)), lambda s: F.when(s.isNotNull(), F.when(s != "", F.array(s)).otherwise(_empty()))
                .when(_is_obj(item), obj).otherwise(_empty()))


def _list_text(arr: Column, depth: int) -> Column:
    """Parts of a list joined by a blank line; NULL when the list yields nothing."""
    parts = F.flatten(F.transform(arr, lambda it: _item_parts(it, depth)))
    return _let(parts, lambda p: F.when(F.size(p) > 0, F.array_join(p, "\n\n")))


def response_text(raw: Column, depth: int = INLINE) -> Column:
    """One display text from a response given as JSON text, reading ``depth`` lists inside its list."""
    return _let(F.try_parse_json(raw), lambda v: F.when(v.isNull(), raw).otherwise(_variant_text(v, depth)))


def _variant_text(v: Column, depth: int) -> Column:
    return _object_text(v, _let(_source(v), lambda x: F.when(x.isNotNull(), F.coalesce(_list_text(x["l"], depth), x["j"]))))


def _source(v: Column) -> Column:
    """struct<l, j>: the one list that the formatter descends into and its JSON text; null if there is none."""
    arr = _arr(v)
    preds = _arr(_get(v, "predictions"))
    output = _arr(_get(v, "output"))
    outputs = _arr(_get(v, "outputs"))
    content = _get(v, "content")
    cstr = _strip(_str(content))
    carr = _arr(content)
    # By the object precedence: predictions, output, outputs, then content when it is a list.
    return (F.when(arr.isNotNull(), F.struct(arr.alias("l"), _json(v).alias("j")))
            .when(F.size(preds) > 0, F.struct(preds.alias("l"), _json(_get(v, "predictions")).alias("j")))
            .when(F.size(output) > 0, F.struct(output.alias("l"), _json(_get(v, "output")).alias("j")))
            .when(F.size(outputs) > 0, F.struct(outputs.alias("l"), _json(_get(v, "outputs")).alias("j")))
            .when(cstr.isNotNull() & (cstr != ""), F.lit(None))
            .when(F.size(carr) > 0, F.struct(carr.alias("l"), _json(content).alias("j"))))


def _object_text(v: Column, listed: Column) -> Column:
    """The display text of a response, given that of its list (null if it has none)."""
    output = _arr(_get(v, "output"))
    cstr = _strip(_str(_get(v, "content")))
    keys = F.json_object_keys(_json(v))
    vid = _get(v, "id")
    empty_output = _falsy(_get(v, "outputs")) & (F.size(output) == 0) & ~_falsy(vid)
    first = F.try_variant_get(v, "$.choices[0]", "variant")
    msg = F.when(_is_obj(first), F.coalesce(_get(first, "message"), first)).otherwise(first)
    has_choices = F.size(_arr(_get(v, "choices"))) > 0
    choice = F.when(_is_obj(msg), F.coalesce(_str(_get(msg, "content")), _json(msg))).otherwise(_json(v))
    meta_only = F.forall(keys, lambda k: k.isin(BENIGN_KEYS)) | (
        (F.size(keys) <= 6) & F.array_contains(keys, "id") & ~F.exists(keys, lambda k: k.isin(OUTPUT_KEYS)))
    rid = F.when(vid.isNull(), F.lit("''")).otherwise(_py_repr(vid))
    # ``listed`` is NULL exactly when no list source applies, so a non-blank text content is next.
    obj = (F.when(cstr.isNotNull() & (cstr != ""), cstr)
           .when(empty_output, F.concat(F.lit(EMPTY_OUTPUT_NOTICE), _py_repr(vid)))
           .when(has_choices, choice)
           .when(meta_only, F.concat(F.lit(METADATA_NOTICE), rid))
           .otherwise(_json(v)))
    return (F.when(listed.isNotNull(), listed)
            .when(_is_obj(v), obj)
            .otherwise(F.coalesce(_str(v), _json(v))))


def _texts_of_lists(lists: DataFrame) -> DataFrame:
    """(id, text) of a written table of (id, list) rows, text null if a list yields nothing; lists inside lists are read to any depth."""
    items = lists.select("id", F.posexplode("list").alias("pos", "item"))
    keys = F.array(*[_arr(_get(F.col("item"), key)) for key in ("outputs", "output", "predictions")])
    nested = write_scratch(items.select("id", "pos", F.posexplode(keys).alias("key", "list")).filter(F.size("list") > 0)
                           .select(F.struct("id", "pos", "key").alias("id"), "list"), "response-lists")
    found = items.select("id", "pos", F.lit(9).alias("key"), _item_parts(F.col("item"), 0).alias("parts"))
    if nested.take(1):
        texts = _texts_of_lists(nested).filter(_strip(F.col("text")) != "")
        found = found.unionAll(texts.select("id.id", "id.pos", "id.key", F.array(_strip(F.col("text")))))
    # One list is part of one response, so one row. The first nested list that yields text stands for its item.
    ordered = F.array_sort(F.collect_list(F.struct("pos", "key", "parts")))
    lead = F.filter(F.col("x"), lambda e, i: (i == 0) | (F.get(F.col("x"), i - 1)["pos"] != e["pos"]))
    texts = found.groupBy("id").agg(ordered.alias("x")).select("id", F.flatten(F.transform(lead, lambda e: e["parts"])).alias("p")) \
        .select("id", F.when(F.size("p") > 0, F.array_join("p", "\n\n")).alias("text"))
    return write_scratch(texts, "response-texts")


def flatten_responses(df: DataFrame, json_col: str, out: str = "content") -> DataFrame:
    """``out`` = the display text of each response, whatever the depth of its lists."""
    n = F.coalesce(F.size(F.regexp_extract_all(F.col(json_col), F.lit(_ENVELOPES), 0)), F.lit(0))
    deep = df.filter(n > INLINE)
    if df.isStreaming or not deep.take(1):
        return spread(df).withColumn(out, response_text(F.col(json_col)))
    deep = write_scratch(deep.select(F.struct(*df.columns).alias("row"), F.col(json_col).alias("raw"))
                         .withColumn("id", F.monotonically_increasing_id()), "deep-responses")
    parsed = deep.withColumn("v", F.try_parse_json("raw"))
    lists = parsed.select("id", _source(F.col("v")).alias("s")).filter("s IS NOT NULL")
    texts = _texts_of_lists(write_scratch(lists.select("id", F.col("s.l").alias("list")), "response-lists"))
    listed = lists.select("id", F.col("s.j").alias("j")).join(texts, "id", "left").select("id", F.coalesce("text", "j").alias("listed"))
    read = parsed.join(listed, "id", "left").select("row.*", F.when(F.col("v").isNull(), F.col("raw")).otherwise(
        _object_text(F.col("v"), F.col("listed"))).alias(out))
    flat = spread(df.filter(n <= INLINE)).withColumn(out, response_text(F.col(json_col)))
    return flat.select(*read.columns).unionAll(read)


def chat_history(df: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role",
                 text: str = "text") -> DataFrame:
    """Per conversation the ordered (role, content) list; ``accepted`` if it ends in a non-blank user text.

    collect_list runs per conversation (bounded by one chat), after a partial aggregate.
    """
    msgs = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(role).alias("role"),
                                                F.col(text).alias("content"))))
    g = df.groupBy(key).agg(msgs.alias("__m"))
    n = F.size("__m")
    # The text a user has just sent is trimmed; what was said before stays as it was.
    messages = F.transform("__m", lambda m, i: F.struct(
        m["role"].alias("role"), F.when((i == n - 1) & (m["role"] == "user"), _strip(m["content"])).otherwise(m["content"]).alias("content")))
    last = F.element_at(F.col("__m"), -1)
    return g.select(key, messages.alias("messages"), F.size("__m").cast("bigint").alias("n_messages"),
                    ((last["role"] == "user") & (_strip(last["content"]) != "")).alias("accepted"))


def response_envelope(df: DataFrame, keys: list[str], text_col: str, out: str = "envelope") -> DataFrame:
    """C4: a response (JSON or plain text) -> JSON list of message items.

    In this order: a list of objects, or such a list under ``output`` or ``outputs``, is the answer as it is; of
    ``predictions`` the first one counts (its ``output`` list, its ``output`` text, itself if it is a message, its
    display text, or its own text); the first of ``choices`` gives its message text; everything else its display
    text. A text becomes one completed assistant message. Its id is derived from a hash of the row keys, so reruns
    give the same ids.
    """
    raw, v, fallback, text = fresh_names(df, "raw", "v", "fallback", "text")
    first = F.try_variant_get(F.col(v), "$.predictions[0]", "variant")
    preds = _get(F.col(v), "predictions")
    df = df.withColumn(raw, F.col(text_col)).withColumn(v, F.try_parse_json(raw))
    df = df.withColumn(fallback, F.when(_is_obj(first), F.concat(F.lit("["), F.to_json(first), F.lit("]")))
                       .when(F.size(_arr(preds)) > 0, F.to_json(preds)).otherwise(F.col(raw)))
    df = flatten_responses(df, fallback, text)
    rid = F.concat(F.lit("msg_"), F.substring(F.md5(F.concat_ws(":", *[F.col(k).cast("string") for k in keys])), 1, 12))

    def message(txt: Column) -> Column:
        return F.to_json(F.array(F.named_struct(
            F.lit("type"), F.lit("message"), F.lit("id"), rid, F.lit("role"), F.lit("assistant"),
            F.lit("status"), F.lit("completed"),
            F.lit("content"), F.array(F.named_struct(F.lit("type"), F.lit("output_text"), F.lit("text"), txt,
                                                     F.lit("annotations"), F.array().cast("array<string>"))))))

    def items(at: Column) -> Column:
        return F.coalesce(_is_obj(F.get(_arr(at), F.lit(0))), F.lit(False))

    value, inner = F.col(v), _get(first, "output")
    told = _str(F.try_variant_get(value, "$.choices[0].message.content", "variant"))
    answer = (F.when(items(value), F.to_json(value))
              .when(~F.coalesce(_is_obj(value), F.lit(False)), message(F.col(raw)))
              .when(items(_get(value, "output")), F.to_json(_get(value, "output")))
              .when(items(_get(value, "outputs")), F.to_json(_get(value, "outputs")))
              .when(_is_obj(first) & (F.size(_arr(inner)) > 0), F.to_json(inner))
              .when(_is_obj(first) & (_strip(_str(inner)) != ""), message(_str(inner)))
              .when(_is_obj(first) & (_str(_get(first, "type")) == "message"), F.concat(F.lit("["), F.to_json(first), F.lit("]")))
              .when(_is_obj(first), message(F.col(text)))
              .when(_is_str(first), message(_str(first)))
              .when(_strip(told) != "", message(told))
              .otherwise(message(F.col(text))))
    return df.withColumn(out, answer).drop(raw, v, fallback, text)


def fresh_names(df: DataFrame, *names: str) -> list[str]:
    """Names of helper columns that clash with no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    return [next(x for k in range(len(taken) + 2) if (x := "_" * (k + 2) + n) not in taken) for n in names]
