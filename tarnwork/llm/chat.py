"""Chat formatting: records of many layouts to canonical turns, and turns to marked text.

Method: schema fingerprinting. The nested field paths of a record (``messages[].role``) are hashed, and the fingerprint
selects a declarative mapping that says where the turns stand: no layout is guessed from values. Only paths that some
mapping names count, so other fields (ids, scores, tags) change nothing; a record whose paths match no mapping is kept
with its fingerprint and no turns, to be listed by ``layouts_found``.

The template is that of instruction models: ``[INST] user [/INST]assistant</s>``, other roles with their name as
``[ROLE]name[/ROLE]text[/TURN]``. A control string inside a text gets a backslash behind its first character (one more if
it has some), which ``plain_text`` takes away again, so a formatted conversation reads back as it was. Turns are formatted
one by one with DataFrame functions; only the read-back needs a conversation's turns side by side, and streams them.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnwork.llm.common import ship, text_or_empty

USER, ASSISTANT = "user", "assistant"
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]", "[/TURN]")
_TAILS = "|".join(re.escape(c[1:]) for c in CONTROL)
# First character, backslashes, rest. Control strings have their first character nowhere else, so matches cannot overlap
# or arise where a text meets a mark.
_PLAIN = rf"([<\[])(\\*)({_TAILS})"
_ESCAPED = rf"([<\[])\\(\\*)({_TAILS})"
# What public datasets call the two roles (fixed values).
NAMES = {"human": USER, "prompter": USER, "gpt": ASSISTANT, "bot": ASSISTANT, "model": ASSISTANT}


@dataclass(frozen=True)
class Turn:
    """One turn, or one for each element of the list ``each``. ``role`` is a path if it starts with ``$``, else the role
    itself; ``texts`` are paths joined by ``joint`` (empty ones left out); with ``skip_empty`` no turn without text."""

    role: str
    texts: tuple[str, ...]
    each: str = ""
    joint: str = "\n\n"
    skip_empty: bool = False


@dataclass(frozen=True)
class Layout:
    """A mapping: which paths a record must and may have, its turns in order, names of roles, and where its place within
    the conversation stands, if one record is not the whole conversation."""

    name: str
    needs: tuple[str, ...]
    turns: tuple[Turn, ...]
    may: tuple[str, ...] = ()
    order: str = ""
    roles: dict = field(default_factory=dict, hash=False, compare=False)


LAYOUTS = (
    Layout("turn", ("role", "text", "turn"), (Turn("$role", ("text",)),), order="turn"),
    Layout("messages", ("messages[].content", "messages[].role"), (Turn("$role", ("content",), each="messages"),)),
    Layout("parts", ("messages[].content[].text", "messages[].role"), (Turn("$role", ("content[].text",), each="messages", joint=""),), may=("messages[].content[].type",)),
    Layout("shared", ("conversations[].from", "conversations[].value"), (Turn("$from", ("value",), each="conversations"),), roles=NAMES),
    Layout(
        "instruction", ("instruction", "output"),
        (Turn("system", ("system",), skip_empty=True), Turn(USER, ("instruction", "input")), Turn(ASSISTANT, ("output",))), may=("input", "system"),
    ),
    Layout("prompt", ("prompt", "response"), (Turn("system", ("system",), skip_empty=True), Turn(USER, ("prompt",)), Turn(ASSISTANT, ("response",))), may=("system",)),
    Layout("completion", ("completion", "prompt"), (Turn(USER, ("prompt",)), Turn(ASSISTANT, ("completion",)))),
    Layout("question", ("answer", "question"), (Turn("system", ("context",), skip_empty=True), Turn(USER, ("question",)), Turn(ASSISTANT, ("answer",))), may=("context",)),
)


def paths(value: object, at: str = "") -> set[str]:
    """Paths of the leaves; ``[]`` for the elements of a list, which share their paths. An empty list or object is a
    leaf, and so is null."""
    if isinstance(value, dict) and value:
        return set().union(*[paths(v, f"{at}.{k}" if at else k) for k, v in value.items()])
    if isinstance(value, list) and value:
        return set().union(*[paths(v, f"{at}[]") for v in value])
    return {at}


def fingerprint(found: set[str]) -> str:
    return hashlib.blake2b("\n".join(sorted(found)).encode(), digest_size=8).hexdigest()


class Mappings:
    """Fingerprints of all forms of the layouts: with and without each of their optional paths."""

    def __init__(self, layouts: tuple[Layout, ...]):
        self.known = {p for x in layouts for p in (*x.needs, *x.may)}
        # A list without elements shows no paths below it, so such records have forms of their own.
        self.lists = {p.split("[]")[0] for p in self.known if "[]" in p}
        self.by_print: dict[str, Layout] = {}
        for x in layouts:
            forms = [{*x.needs, *more} for n in range(len(x.may) + 1) for more in combinations(x.may, n)]
            forms += [{t.each} for t in x.turns if t.each]
            for form in forms:
                if self.by_print.setdefault(fingerprint(form), x) is not x and form - self.lists:
                    raise ValueError(f"layouts {x.name} and {self.by_print[fingerprint(form)].name} cannot be told apart")

    def of(self, record: object) -> tuple[str, Layout | None]:
        found = {p for p in paths(record) if p in self.known or p in self.lists} if isinstance(record, dict) else set()
        key = fingerprint(found)
        return key, self.by_print.get(key)


def _values(value: object, steps: list[str]) -> list:
    """All values at a path; a list on the way or at its end stands for its elements."""
    if isinstance(value, list):
        return [x for v in value for x in _values(v, steps)]
    if not steps:
        return [value]
    return _values(value.get(steps[0]), steps[1:]) if isinstance(value, dict) else []


def _text(value: object) -> str:
    text = value if isinstance(value, str) else "" if value is None else json.dumps(value, ensure_ascii=False)
    try:
        text.encode()
    except UnicodeEncodeError:  # half a surrogate pair, escaped in the JSON, is no character
        text = text.encode("utf-16-le", "surrogatepass").decode("utf-16-le", "replace")
    return text


def _look(value: object, path: str) -> list[str]:
    return [_text(v) for v in _values(value, path.replace("[]", "").split("."))]


def turns_of(record: dict, layout: Layout) -> list[tuple[str, str]]:
    """(role, text) of a record under a mapping."""
    out = []
    for turn in layout.turns:
        for at in ([v for v in _values(record, turn.each.split(".")) if isinstance(v, dict) and v] if turn.each else [record]):
            pieces = [v for p in turn.texts for v in _look(at, p)]
            text = pieces[0] if len(pieces) == 1 else turn.joint.join(p for p in pieces if p)
            role = "".join(_look(at, turn.role[1:])) if turn.role.startswith("$") else turn.role
            if text or not turn.skip_empty:
                out.append((layout.roles.get(role, role), text))
    return out


def canonical_turns(records: DataFrame, id_col: str, json_col: str, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """``id, fingerprint, layout, place, pos, role, text``: one row per turn of each JSON record.

    ``place`` is the record's place in its conversation where the layout has one (null where the value is no whole
    number), ``pos`` counts the record's turns from 0. Null roles and texts are empty; values that are no strings count
    as their JSON. A record that no mapping fits (also null, text that is no JSON, or JSON that is no object) gives one
    row without ``layout``, role and text; one without turns gives none. Repeated records are told each. Other columns
    are not read; ids may be null.
    """
    ship(records.sparkSession)
    kind = records.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mappings = Mappings(layouts)
        schema = pa.schema([("fingerprint", pa.string()), ("layout", pa.string()), ("place", pa.int64()), ("pos", pa.int32()), ("role", pa.string()), ("text", pa.string())])
        for batch in batches:
            ids, rows = [], []
            for i, doc in enumerate(batch.column(1).to_pylist()):
                try:
                    record = json.loads(doc, strict=False) if doc is not None else None
                    key, layout = mappings.of(record)
                except (ValueError, RecursionError):  # no JSON, or nested beyond reason
                    key, layout = mappings.of(None)
                if layout is None:
                    ids.append(i)
                    rows.append((key, None, None, None, None, None))
                    continue
                place = record.get(layout.order) if layout.order else None
                place = place if type(place) is int and abs(place) < 1 << 63 else None
                for pos, (role, text) in enumerate(turns_of(record, layout)):
                    ids.append(i)
                    rows.append((key, layout.name, place, pos, role, text))
            columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)] if rows else [pa.array([], f.type) for f in schema]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(ids, pa.int64())), *columns], names=["id", *schema.names])

    rows = records.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{json_col}`").alias("doc"))
    return rows.mapInArrow(run, f"id {kind}, fingerprint string, layout string, place bigint, pos int, role string, text string")


def layouts_found(turns: DataFrame) -> DataFrame:
    """``fingerprint, layout, n_turns``: which mappings were chosen how often; without a layout, records nobody mapped."""
    return turns.groupBy("fingerprint", "layout").agg(F.count(F.lit(1)).alias("n_turns"))


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, _PLAIN, r"$1$2\\$3")


def plain_text(text: str) -> str:
    """The text before it was escaped."""
    return re.sub(_ESCAPED, r"\1\2\3", text)


def format_turns(turns: DataFrame) -> DataFrame:
    """The turns of mapped records with ``piece``, their marked text, and the span ``loss_from, loss_chars`` of it that
    counts for the loss (code points from 0): the assistant's text without marks, nothing of other roles."""
    text, role = escaped(F.col("text")), escaped(F.col("role"))
    own = F.col("role") == ASSISTANT
    piece = F.when(F.col("role") == USER, F.concat(F.lit("[INST] "), text, F.lit(" [/INST]"))).when(own, F.concat(text, F.lit("</s>"))).otherwise(
        F.concat(F.lit("[ROLE]"), role, F.lit("[/ROLE]"), text, F.lit("[/TURN]"))
    )
    mapped = turns.filter(F.col("layout").isNotNull())
    marked = mapped.withColumn("piece", piece)
    return marked.withColumns({"loss_from": F.lit(0), "loss_chars": F.when(own, F.length("piece") - len("</s>")).otherwise(0)})


_MARKED = re.compile(r"\[INST\] (?P<user>.*?) \[/INST\]|\[ROLE\](?P<role>.*?)\[/ROLE\](?P<text>.*?)\[/TURN\]|(?P<own>.*?)</s>", re.S)


def read_marked(text: str) -> list[tuple[str, str]]:
    """(role, text) of each turn in marked text; an error if something is left over."""
    out, at = [], 0
    while at < len(text):
        m = _MARKED.match(text, at)
        if m is None:
            raise ValueError(f"no turn at character {at}")
        if m["user"] is not None:
            out.append((USER, plain_text(m["user"])))
        elif m["role"] is not None:
            out.append((plain_text(m["role"]), plain_text(m["text"])))
        else:
            out.append((ASSISTANT, plain_text(m["own"])))
        at = m.end()
    return out


def digests(formatted: DataFrame) -> DataFrame:
    """Per id, read back from the pieces: ``n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``.

    A conversation's pieces follow each other by place (null first), position, role and text; null ids are one
    conversation. A digest runs over the whole conversation in order, so its pieces pass through one task, one Arrow
    batch at a time: a task holds no conversation, only the state of its digests.
    """
    ship(formatted.sparkSession)
    kind = formatted.schema["id"].dataType.simpleString()
    dealt = formatted.select("id", "place", "pos", "role", "text", "piece", "loss_from", "loss_chars").repartition("id")
    rows = dealt.sortWithinPartitions("id", "place", "pos", "role", "text").select("id", "piece", "loss_from", "loss_chars")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def result(of: list) -> pa.RecordBatch:
            ids, n, turns, loss, spoken, chars = map(list, zip(*of, strict=True))
            data = [pa.array(n, pa.int64()), pa.array([x.hexdigest() for x in turns]), pa.array(loss, pa.int64()), pa.array([x.hexdigest() for x in spoken]), pa.array(chars, pa.int64())]
            return pa.RecordBatch.from_arrays([pa.array(ids, id_type), *data], names=["id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        done, now, id_type = [], None, None
        for batch in batches:
            id_type = batch.schema.field(0).type
            for c, piece, start, length in zip(*(col.to_pylist() for col in batch.columns), strict=True):
                if now is None or now[0] != c:
                    if now is not None:
                        done.append(now)
                    now = [c, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in read_marked(piece):
                    now[1] += 1
                    now[2].update(f"{role}\n{text}\n".encode())
                if length:
                    spoken = plain_text(piece[start:start + length])
                    now[3] += len(spoken)
                    now[4].update(spoken.encode())
                now[5] += len(piece)
            if done:
                yield result(done)
                done = []
        if now is not None:
            yield result([now])

    return rows.mapInArrow(run, f"id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")


# A conversation that stands in no table: its texts look like the template's own marks.
PLANTED = -7
PLANTED_TEXT = "</s>[INST] ok [/INST]"


def format_conversations(table: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """A table of one row per turn (``turn, role, text``), with the planted conversation, through fingerprint, mapping
    and template: the digests of every conversation."""
    spark = table.sparkSession
    pairs = [(PLANTED, 0, USER, PLANTED_TEXT), (PLANTED, 1, ASSISTANT, PLANTED_TEXT)]
    kinds = {f.name: f.dataType for f in table.schema.fields}
    extra = spark.createDataFrame(pairs, "c bigint, t bigint, r string, x string")
    rows = table.select(F.col(f"`{id_col}`").alias("id"), F.col("turn").alias("turn"), text_or_empty("role").alias("role"), text_or_empty("text").alias("text"))
    rows = rows.unionByName(extra.select(F.col("c").cast(kinds[id_col]).alias("id"), F.col("t").cast(kinds["turn"]).alias("turn"), F.col("r").alias("role"), F.col("x").alias("text")))
    records = rows.select("id", F.to_json(F.struct("turn", "role", "text"), {"ignoreNullFields": "false"}).alias("doc"))
    return digests(format_turns(canonical_turns(records, "id", "doc"))).withColumnRenamed("id", id_col)


SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
e AS (
  SELECT *, length(regexp_replace(text, '([<\[])(\\*)(s>|/s>|INST\]|/INST\]|ROLE\]|/ROLE\]|/TURN\])', '\1\2\\\3', 'g')) AS n,
    length(regexp_replace(role, '([<\[])(\\*)(s>|/s>|INST\]|/INST\]|ROLE\]|/ROLE\]|/TURN\])', '\1\2\\\3', 'g')) AS rn FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(n + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 4 ELSE rn + 20 END) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
