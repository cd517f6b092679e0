"""Chat formatting of records whose layouts differ, by fingerprints of their schemas.

A record is a JSON text. The paths of its fields and of the fields in its lists of turns, in order and
without types, are hashed; the hash selects a declarative mapping, which says where
roles and texts stand. A record may have any size that a string may have. Every mapping yields the same canonical turns, and
those are written in one template and can be read back from it.

Only DataFrame functions.

Template of a turn:  ``### role: text</turn>\\n``. In roles and texts a
backslash becomes ``\\e``, ``#`` becomes ``\\h``, ``<`` becomes ``\\l``, and in roles a colon becomes ``\\c``, so no text holds a
control string and every one can be restored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, MIDDLE, CLOSE = "### ", ": ", "</turn>\n"
CODES = (("\\", "\\e"), ("#", "\\h"), ("<", "\\l"), (":", "\\c"))
TURNS = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class Layout:
    """paths: the field paths of the records. turns: SQL for the canonical turns, over the parsed record ``r``."""

    name: str
    paths: tuple[str, ...]
    turns: str


def _flat(*fields: tuple[str, str]) -> str:
    return "array(" + ", ".join(f"named_struct('role', '{role}', 'text', coalesce(r.`{field}`, ''))" for role, field in fields) + ")"


def _listed(field: str, role: str, text: str, names: dict[str, str] | None = None) -> str:
    """Turns of a list; ``names`` are the roles that the layout calls by other names, all other roles stay as they are."""
    whens = "".join(f" when '{name}' then '{means}'" for name, means in (names or {}).items())
    said = f"case x.`{role}`{whens} else x.`{role}` end" if whens else f"x.`{role}`"
    return f"transform(r.`{field}`, x -> named_struct('role', coalesce({said}, ''), 'text', coalesce(x.`{text}`, '')))"


#: The mappings. Roles of the "conversations" layout have the names human and gpt.
LAYOUTS = (
    Layout("messages", ("messages[].content", "messages[].role"), _listed("messages", "role", "content")),
    Layout("conversations", ("conversations[].from", "conversations[].value"), _listed("conversations", "from", "value", {"human": "user", "gpt": "assistant"})),
    Layout("prompt", ("completion", "prompt"), _flat(("user", "prompt"), ("assistant", "completion"))),
    Layout("instruction", ("instruction", "output", "system"), _flat(("system", "system"), ("user", "instruction"), ("assistant", "output"))),
    Layout("question", ("answer", "question"), _flat(("user", "question"), ("assistant", "answer"))),
)
RECORD = ("messages array<struct<role:string,content:string>>, conversations array<struct<from:string,value:string>>, prompt string, "
          "completion string, instruction string, output string, system string, question string, answer string")


#: Else the JSON reader takes a text of more than 20 million characters as null.
WHOLE = {"maxStringLen": str((1 << 31) - 1)}


def _plain(key: Column) -> Column:
    return F.replace(F.replace(key, F.lit("\\"), F.lit("\\\\")), F.lit("["), F.lit("\\["))


def with_paths(records: DataFrame, record: str, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """``records`` plus the parsed record ``r`` and ``paths``: the names of a JSON record's fields in order, such as ``messages[].content``;
    null for no JSON object, or one that names a field twice.

    A list of turns gives the names of all its objects' fields, one without objects its own name and ``[]``. Of the layouts' fields, one
    that holds objects is marked ``{}``, one that holds lists ``[]``; in other fields nothing is looked into.
    """
    heads = {head: inner for head, _, inner in (path.partition("[].") for layout in layouts for path in layout.paths)}
    lists = [head for head, inner in heads.items() if inner]
    parsed = lambda schema: F.from_json(F.col(record), schema, WHOLE)

    def once(keys: Column) -> Column:
        return F.when(F.size(F.array_distinct(keys)) < F.size(keys), F.array(F.lit("twice["))).otherwise(keys)

    def names(head: str) -> Column:
        """The field names of a list's objects, and "[" if there is an object; null for no list."""
        items = parsed(f"`{head}` array<string>")[head]
        return F.aggregate(items, F.array().cast("array<string>"), lambda a, x: F.when(x.isNull(), a).otherwise(
            F.array_union(F.array_union(a, F.array(F.lit("["))), F.coalesce(once(F.json_object_keys(x)), a))))

    own = records.select("*", F.json_object_keys(F.col(record)).alias("_keys"), parsed(RECORD).alias("r"),
                         F.struct(*[names(head).alias(head) for head in lists]).alias("_names"))
    # an object or list that is read as a string keeps its bracket; only records with such a text are parsed again
    known = {head: sorted(path.partition("[].")[2] for layout in layouts for path in layout.paths if path.startswith(f"{head}[].")) for head in lists}
    bracket = lambda text: F.coalesce(F.substring(text, 1, 1).isin("{", "["), F.lit(False))
    odd = F.lit(False)
    for head in heads:
        texts = [F.exists(F.col("r")[head][k], bracket) for k in known[head]] if head in lists else [bracket(F.col("r")[head])]
        for text in texts:
            odd = odd | F.coalesce(text, F.lit(False))
    own = own.withColumns({name: F.when(odd, parsed(RECORD.replace("string", f"{kind}string>"))) for name, kind in (("_objects", "map<string,"), ("_lists", "array<"))})

    def marked(name: Column, held: Column, objects: Column, arrays: Column) -> Column:
        return F.concat(name, F.when((objects > 0) & (objects == held), "{}").when((arrays > 0) & (arrays == held), "[]").otherwise(""))

    def below(head: str) -> Column:
        found = F.col("_names")[head]

        def path(name: Column) -> Column:
            out = _plain(name)
            for k in known[head]:
                n = [F.size(F.filter(F.col(c)[head][k], lambda x: x.isNotNull())) for c in ("r", "_objects", "_lists")]
                out = F.when(name == k, marked(F.lit(k), *n)).otherwise(out)
            return F.concat(F.lit(f"{head}[]."), out)

        inner = F.transform(F.array_sort(F.array_remove(found, "[")), path)
        return (F.when(F.col("r")[head].isNull(), F.array(F.when(found.isNull(), head).otherwise(f"{head}[?]")))
                .when(F.size(found) == 0, F.array(F.lit(f"{head}[]")))
                .when(F.size(found) == 1, F.array(F.lit(f"{head}[]{{}}"))).otherwise(inner))

    def field(key: Column) -> Column:
        out = F.array(_plain(key))
        for head in heads:
            n = [F.col(c)[head].isNotNull().cast("int") for c in ("r", "_objects", "_lists")]
            out = F.when(key == head, below(head) if head in lists else F.array(marked(F.lit(head), *n))).otherwise(out)
        return out

    paths = F.flatten(F.transform(F.array_sort("_keys"), field))
    return own.withColumn("paths", F.when(F.size(F.array_distinct("_keys")) == F.size("_keys"), paths)).drop("_keys", "_objects", "_lists", "_names")


def fingerprint(paths: Column) -> Column:
    return F.sha2(F.to_json(paths), 256)


def canonical_turns(layouts: tuple[Layout, ...] = LAYOUTS) -> Column:
    """Struct of layout (name, null if no mapping fits) and turns (array of role and text) of the parsed record ``r``.

    Null roles and texts are empty. A list of turns that
    is empty has no paths below it; its record is mapped by the list's name.
    """
    choose, name = None, None
    for layout in layouts:
        hit = F.col("fingerprint") == fingerprint(F.array(*map(F.lit, layout.paths)))
        if "[]." in layout.paths[0]:
            hit = hit | (F.col("fingerprint") == fingerprint(F.array(F.lit(layout.paths[0].partition(".")[0]))))
        turns = F.expr(layout.turns)
        choose = F.when(hit, turns) if choose is None else choose.when(hit, turns)
        name = F.when(hit, F.lit(layout.name)) if name is None else name.when(hit, F.lit(layout.name))
    return F.struct(name.alias("layout"), choose.alias("turns"))


def with_turns(records: DataFrame, record: str = "record", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """``records`` plus fingerprint, layout and turns. A record that is no JSON or of an unknown schema keeps null turns, so nothing is guessed."""
    own = with_paths(records, record, layouts)
    own = own.withColumn("fingerprint", fingerprint(F.col("paths"))).withColumn("_c", canonical_turns(layouts))
    return own.withColumn("layout", F.col("_c.layout")).withColumn("turns", F.coalesce(F.col("_c.turns"), F.lit(None).cast(TURNS))).drop("_c", "r", "paths")


def escaped(text: Column, codes=CODES[:3]) -> Column:
    for plain, code in codes:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def restored(text: Column, codes=CODES) -> Column:
    for plain, code in reversed(codes):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def formatted(turns: Column) -> Column:
    """Canonical turns in the template; empty for none, null for null."""
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit(OPEN), escaped(t["role"], CODES), F.lit(MIDDLE), escaped(t["text"]), F.lit(CLOSE))), "")


def read_back(output: Column) -> Column:
    """The turns of a formatted text: array of role, text and loss (whether the text is under the loss mask, as an assistant's is)."""
    parts = F.filter(F.split(output, CLOSE, -1), lambda x: x != "")

    def turn(x: Column) -> Column:
        body = F.substr(x, F.lit(len(OPEN) + 1))
        cut = F.instr(body, MIDDLE)
        role = restored(F.substr(body, F.lit(1), cut - 1))
        return F.struct(role.alias("role"), restored(F.substr(body, cut + len(MIDDLE))).alias("text"), (role == "assistant").alias("loss"))

    return F.transform(parts, turn)


def conversation_records(rows: DataFrame) -> DataFrame:
    """(conv_id, record) from rows of conv_id, turn, role, text: one JSON record a conversation, in the layout that suits its shape.

    A user and an assistant: prompt and completion. System, user, assistant: instruction. Else, with
    only those three roles: conversations with human and gpt for odd ids, messages for the others and all other roles. Rows are in order of turn (nulls first),
    then role and text; each row is a turn; a null text is empty, a null role too; a null conv_id is a conversation of its own.
    A conversation becomes one text, so one task holds it whole; that is what the output asks for.
    """
    t = F.struct(rows["turn"].cast("long").alias("turn"), F.coalesce(rows["role"], F.lit("")).alias("role"), F.coalesce(rows["text"], F.lit("")).alias("text"))
    own = rows.select(rows["conv_id"].cast("long").alias("conv_id"), t.alias("t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    own = own.withColumn("roles", F.transform("t", lambda x: x["role"]))
    plain = F.forall("roles", lambda x: x.isin("user", "assistant", "system"))
    text = lambda k: F.col("t")[k]["text"]
    named = F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("content")))
    share = F.transform("t", lambda x: F.struct(
        F.when(x["role"] == "user", "human").when(x["role"] == "assistant", "gpt").otherwise(x["role"]).alias("from"), x["text"].alias("value")))
    joined = F.array_join("roles", ",")
    record = (F.when((joined == "user,assistant"), F.to_json(F.struct(text(0).alias("prompt"), text(1).alias("completion"))))
              .when((joined == "system,user,assistant"), F.to_json(F.struct(text(0).alias("system"), text(1).alias("instruction"), text(2).alias("output"))))
              .when(plain & (F.pmod("conv_id", F.lit(2)) == 1), F.to_json(F.struct(share.alias("conversations"))))
              .otherwise(F.to_json(F.struct(named.alias("messages")))))
    return own.select("conv_id", record.alias("record"))


def formatted_conversations(records: DataFrame) -> DataFrame:
    """``records`` (conv_id, record) with their formatted text."""
    own = with_turns(records)
    return own.withColumn("formatted", formatted(F.col("turns")))
