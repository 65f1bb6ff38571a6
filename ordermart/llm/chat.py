"""Chat formatting, with schema fingerprints choosing the mapping.

Records come in many layouts: one row a turn, a list of messages, prompt and
answer columns, instruction with input and output, nested variants of these.
A record's schema is reduced to its nested field paths ("messages[].role");
the SHA-256 of the sorted paths is its fingerprint, and a registry maps
fingerprints to declarative mappings: plain expressions that turn a record
into canonical turns.  Typed tables have one fingerprint each; JSON records
(``from_json_records``) are told apart row by row.  A layout without a mapping
is an error that names its paths.

Canonical turns are rows (conv_id, turn, role, text), so a conversation of any
length is formatted turn by turn on many tasks.  The template marks each turn
with control strings; the same strings inside a role or text are broken by an
escape character, which unescaping takes out again, so that any text survives a
round trip.  ``formatted`` joins the segments of a conversation when one string
is wanted, with the loss mask as character spans.

Only DataFrame functions are used; there is no Python on the executors.

Defined results: a null text or role is empty; turns go by number (none first),
equal numbers by role, then text; repeated rows are turns of their own; a null
conversation id is one conversation; empty tables give empty results; other
columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import sha256

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ordermart.session import scratch_path

# The control strings of the template and of common chat
# templates, and the escape character (a private-use code point).
START, MIDDLE, STOP = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
CONTROL = [START, MIDDLE, STOP, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|endoftext|>"]
ESCAPE = "\ue000"
TRAINED_ROLE = "assistant"

TURNS = "conv_id long, turn long, role string, text string"


# -- fingerprints ------------------------------------------------------------------

def field_paths(kind: T.DataType, prefix: str = "") -> list[str]:
    """Nested field paths of a type; [] marks a list, {} a map's values."""
    if isinstance(kind, T.StructType):
        return [p for f in kind.fields for p in field_paths(f.dataType, f"{prefix}.{f.name}" if prefix else f.name)]
    if isinstance(kind, T.ArrayType):
        return field_paths(kind.elementType, prefix + "[]")
    if isinstance(kind, T.MapType):
        return field_paths(kind.valueType, prefix + "{}")
    return [prefix]


def fingerprint(paths: list[str]) -> str:
    return sha256("\n".join(sorted(paths)).encode()).hexdigest()


def _paths(*paths: str) -> frozenset[str]:
    return frozenset(paths)


@dataclass(frozen=True)
class Mapping:
    """A layout: the field paths it has, and how to make its turns.

    ``turns`` is an SQL expression for an array of (turn, role, text); extra
    top-level columns of a table are not part of its layout.
    """
    paths: frozenset[str]
    turns: str

    @property
    def fingerprint(self) -> str:
        return fingerprint(list(self.paths))

    def fields(self) -> frozenset[str]:
        """Top-level fields."""
        return frozenset(p.split(".")[0].replace("[]", "") for p in self.paths)


def _list_turns(items: str, role: str, text: str) -> str:
    return f"transform({items}, (m, i) -> struct(cast(i as long) turn, m.{role} role, m.{text} text))"


def _pair(user: str, answer: str) -> str:
    return (f"array(struct(0L turn, 'user' role, {user} text), "
            f"struct(1L turn, '{TRAINED_ROLE}' role, {answer} text))")


#: Speaker names of the from/value layout and what they are called here.
SPEAKERS = "map('human', 'user', 'gpt', 'assistant', 'system', 'system')"
_FROM_VALUE = ("transform(conversations, (m, i) -> struct(cast(i as long) turn, "
               f"coalesce(try_element_at({SPEAKERS}, m.`from`), m.`from`) role, m.value text))")
_WITH_INPUT = "concat_ws('\\n\\n', instruction, nullif(input, ''))"

REGISTRY: list[Mapping] = [
    # one row a turn
    Mapping(_paths("conv_id", "turn", "role", "text"), "array(struct(turn, role, text))"),
    # message lists
    Mapping(_paths("conv_id", "messages[].role", "messages[].content"), _list_turns("messages", "role", "content")),
    Mapping(_paths("conv_id", "messages[].role", "messages[].text"), _list_turns("messages", "role", "text")),
    Mapping(_paths("conv_id", "conversation.messages[].role", "conversation.messages[].content"),
            _list_turns("conversation.messages", "role", "content")),
    Mapping(_paths("conv_id", "conversations[].from", "conversations[].value"), _FROM_VALUE),
    # prompt and answer
    Mapping(_paths("conv_id", "prompt", "completion"), _pair("prompt", "completion")),
    Mapping(_paths("conv_id", "prompt", "response"), _pair("prompt", "response")),
    Mapping(_paths("conv_id", "question", "answer"), _pair("question", "answer")),
    # instructions
    Mapping(_paths("conv_id", "instruction", "output"), _pair("instruction", "output")),
    Mapping(_paths("conv_id", "instruction", "input", "output"), _pair(_WITH_INPUT, "output")),
]


def to_turns(records: DataFrame, registry: list[Mapping] = REGISTRY) -> DataFrame:
    """Canonical turns of a typed table, by the mapping of its fingerprint.
    Only the fields of known layouts count, so extra columns do no harm; if
    they allow several layouts, the one of most fields is taken."""
    by_print = {m.fingerprint: m for m in registry}
    for fields in sorted({m.fields() for m in registry}, key=lambda f: (-len(f), sorted(f))):
        if fields <= set(records.columns):
            own = records.select(*sorted(fields))
            found = by_print.get(fingerprint(field_paths(own.schema)))
            if found is not None:
                return _turns(own, F.expr(found.turns))
    raise ValueError(f"no mapping for the layout {sorted(field_paths(records.schema))}")


def _turns(records: DataFrame, turns: Column) -> DataFrame:
    each = records.select(F.col("conv_id").cast("long").alias("conv_id"), F.inline(turns))
    return each.select("conv_id", F.col("turn").cast("long").alias("turn"),
                       F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def json_layout(record: Column) -> Column:
    """Nested field names of a JSON record, row by row, in sorted order: its
    schema with the types of the plain values taken out."""
    plain = r": (VOID|BOOLEAN|BIGINT|DOUBLE|FLOAT|STRING|DATE|TIMESTAMP(_NTZ)?|BINARY|UUID|DECIMAL\([0-9,]+\))"
    return F.regexp_replace(F.schema_of_variant(F.try_parse_json(record)), plain, "")


def _tree(m: Mapping) -> dict:
    tree: dict = {}
    for path in m.paths:
        at = tree
        for step in path.replace("[]", ".[]").split("."):
            at = at.setdefault(step, {})
    return tree


def _layout_of(m: Mapping) -> str:
    """What ``json_layout`` gives for a record of this layout."""
    def show(node: dict) -> str:
        if "[]" in node:
            return f"ARRAY<{show(node['[]'])}>"
        return "OBJECT<" + ", ".join(k + (f": {show(v)}" if v else "") for k, v in sorted(node.items())) + ">"
    return show(_tree(m))


def _record_type(m: Mapping) -> str:
    """The type to parse a JSON record of this layout with."""
    def show(name: str, node: dict) -> str:
        if "[]" in node:
            return f"array<{show('', node['[]'])}>"
        if not node:
            return "bigint" if name in ("conv_id", "turn") else "string"
        return "struct<" + ", ".join(f"`{k}`: {show(k, v)}" for k, v in sorted(node.items())) + ">"
    return show("", _tree(m))


def from_json_records(records: DataFrame, column: str = "record",
                      registry: list[Mapping] = REGISTRY) -> DataFrame:
    """Canonical turns of JSON records of mixed layouts.  Each row's layout is
    hashed and the records are stored by fingerprint; each mapping then reads
    the records of its own.  Null records give nothing; a record of an unknown
    layout is an error."""
    spark = records.sparkSession
    layout = F.coalesce(json_layout(F.col("record")), F.lit("not JSON"))
    hashed = (records.select(F.col(column).cast("string").alias("record")).where("record is not null")
              .withColumn("layout", layout).withColumn("fingerprint", F.sha2("layout", 256)))
    path = scratch_path(spark, "chat-records")
    hashed.write.partitionBy("fingerprint").parquet(path)
    stored_records = spark.read.schema("record string, layout string, fingerprint string").parquet(path)
    known = {sha256(_layout_of(m).encode()).hexdigest(): m for m in registry}
    stranger = stored_records.where(~F.col("fingerprint").isin(*known)).select("layout").limit(1).collect()
    if stranger:
        raise ValueError(f"no mapping for the layout {stranger[0]['layout']}")
    turns = spark.createDataFrame([], TURNS)
    for key, m in known.items():
        own = stored_records.where(F.col("fingerprint") == key)
        parsed = own.select(F.from_json("record", _record_type(m)).alias("r")).select("r.*")
        turns = turns.unionByName(_turns(parsed, F.expr(m.turns)))
    return turns


# -- template ----------------------------------------------------------------------

def _quoted(s: str) -> str:
    return "".join("\\" + c if c in "\\[](){}<>|/.*+?^$" else c for c in s)


def escaped(text: Column) -> Column:
    """Every control string, escaped or not, gets one more escape character
    after its first character."""
    for first in sorted({c[0] for c in CONTROL}):
        rests = "|".join(_quoted(c[1:]) for c in CONTROL if c[0] == first)
        text = F.regexp_replace(text, f"({_quoted(first)})({ESCAPE}*)({rests})", f"$1{ESCAPE}$2$3")
    return text


def unescaped(text: Column) -> Column:
    for first in sorted({c[0] for c in CONTROL}):
        rests = "|".join(_quoted(c[1:]) for c in CONTROL if c[0] == first)
        text = F.regexp_replace(text, f"({_quoted(first)}){ESCAPE}({ESCAPE}*)({rests})", "$1$2$3")
    return text


def segments(turns: DataFrame, trained: str = TRAINED_ROLE) -> DataFrame:
    """(conv_id, turn, role, segment, loss_start, loss_end) for every turn: the
    formatted segment, and the characters of it that are trained on (null for
    other roles)."""
    head = F.concat(F.lit(START), escaped(F.col("role")), F.lit(MIDDLE))
    text = escaped(F.col("text"))
    is_trained = F.col("role") == trained
    start = F.char_length("head")
    return (turns.withColumn("head", head).withColumn("body", text)
            .select("conv_id", "turn", "role", F.concat("head", "body", F.lit(STOP)).alias("segment"),
                    F.when(is_trained, start).alias("loss_start"),
                    F.when(is_trained, start + F.char_length("body")).alias("loss_end")))


def read_segments(formatted: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, loss_text, n_chars) parsed back from
    segments: role and text from the marks, loss_text from the mask (null where
    nothing is trained on)."""
    inner = F.col("segment").substr(F.lit(len(START) + 1), F.char_length("segment") - len(START) - len(STOP))
    masked = F.col("segment").substr(F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start"))
    return (formatted.withColumn("inner", inner)
            .select("conv_id", "turn", unescaped(F.substring_index("inner", MIDDLE, 1)).alias("role"),
                    unescaped(F.substring_index("inner", MIDDLE, -1)).alias("text"),
                    unescaped(masked).alias("loss_text"), F.char_length("segment").alias("n_chars")))


def formatted(parts: DataFrame) -> DataFrame:
    """(conv_id, text, loss) of every conversation: its segments joined, and
    the loss mask as (start, end) characters of the joined text."""
    each = F.struct("turn", "role", "segment", "loss_start", "loss_end")
    rows = parts.groupBy("conv_id").agg(F.array_sort(F.collect_list(each)).alias("s"))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start: int, end: int>>").alias("spans"))

    def add(acc: Column, s: Column) -> Column:
        span = F.struct((acc["at"] + s["loss_start"]).alias("start"), (acc["at"] + s["loss_end"]).alias("end"))
        spans = F.when(s["loss_start"].isNull(), acc["spans"]).otherwise(F.concat(acc["spans"], F.array(span)))
        return F.struct((acc["at"] + F.char_length(s["segment"])).alias("at"), spans.alias("spans"))

    return rows.select("conv_id", F.array_join(F.transform("s", lambda s: s["segment"]), "").alias("text"),
                       F.aggregate("s", zero, add)["spans"].alias("loss"))
