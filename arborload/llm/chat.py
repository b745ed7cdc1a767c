"""Chat formatting that is read back and compared."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arborload.llm.shared import require

OPEN_USER, CLOSE_USER = "[INST] ", " [/INST]"
OPEN, CLOSE = "<s>", "</s>"
#: The role whose texts are learnt.
LEARNT = "assistant"
#: A turn: a user's text, or a role up to an unescaped line end and a text.
TURN = r"(?s)\[INST\] .*? \[/INST\]|<s>[^\n\\]*+(?:\\.[^\n\\]*+)*+\n.*?</s>"
ROLE = r"(?s)^<s>([^\n\\]*+(?:\\.[^\n\\]*+)*+)\n"


def escape(text: str) -> str:
    """SQL for a text without control strings: backslashes are doubled, and one is put
    behind the first character of each control string."""
    doubled = rf"replace({text}, '\\', '\\\\')"
    return rf"regexp_replace({doubled}, r'([<\[])(?=/?(?:s>|INST\]))', r'$1\\')"


def unescape(text: str) -> str:
    """SQL that undoes ``escape``: a backslash stands for what follows it."""
    return rf"regexp_replace({text}, r'(?s)\\(.)', '$1')"


def _rendered(turns: str, escaped: str) -> str:
    """SQL for one text of all turns; ``escaped`` tells which of them are escaped."""
    text = f"CASE WHEN {escaped} THEN {escape('t.text')} ELSE t.text END"
    role = rf"replace({escape('t.role')}, '\n', '\\\n')"
    role = f"CASE WHEN {escaped} THEN {role} ELSE t.role END"
    turn = (
        f"CASE WHEN t.role = 'user' THEN concat('{OPEN_USER}', {text}, '{CLOSE_USER}')"
        rf" ELSE concat('{OPEN}', {role}, '\n', {text}, '{CLOSE}') END"
    )
    return f"array_join(transform({turns}, (t, i) -> {turn}), '')"


def _bodies(formatted: str) -> str:
    """SQL for the turns of a formatted text, still escaped: role and text.

    The turns are matched one after the other; what lies between them, if anything,
    becomes a turn without a role, so that nothing is passed over in silence.
    """
    user = f"named_struct('role', 'user', 'text', substring(u, {len(OPEN_USER) + 1}, char_length(u) - {len(OPEN_USER) + len(CLOSE_USER)}))"
    role = f"regexp_extract(u, r'{ROLE}', 1)"
    other = (
        f"named_struct('role', {role}, 'text', substring(u, char_length({role}) + {len(OPEN) + 2},"
        f" char_length(u) - char_length({role}) - {len(OPEN) + len(CLOSE) + 1}))"
    )
    return f"transform(regexp_extract_all({formatted}, r'{TURN}', 0), u -> CASE WHEN startswith(u, '{OPEN_USER}') THEN {user} ELSE {other} END)"


def _parsed(formatted: str) -> str:
    """SQL for the turns of a formatted text."""
    return f"transform({_bodies(formatted)}, b -> named_struct('role', {unescape('b.role')}, 'text', {unescape('b.text')}))"


def _same(formatted: str) -> str:
    """SQL that tells whether the source turns come back, with nothing else in the text."""
    whole = f"array_join(regexp_extract_all({formatted}, r'{TURN}', 0), '') = {formatted}"
    return f"({_parsed(formatted)} = turns AND {whole})"


def formatted(conversations: DataFrame) -> DataFrame:
    """One formatted text per conversation, which parses back to its turns.

    Round 0 renders the turns as they are and parses the result.  Where the turns
    come back changed, round 1 escapes those that differ from what was read in their
    place, and round 2 all.  Escaped text has no control string left, so round 2
    always comes back; ``rounds`` tells which one was taken.

    Returns ``conv_id``, ``turns`` (source), ``formatted``, ``rounds``, ``parsed``
    (read back), ``loss_spans``: start and end, in code points of ``formatted``, of
    every assistant text, and ``loss_texts``: these texts as read back.  Turns are ordered by ``turn``, then role and text, NULL
    first.  NULL text and NULL role are empty.  Rows with a NULL ``conv_id`` form one
    conversation.  Repeated rows are repeated turns.  A conversation is one row, so it
    is gathered in one task.  An empty table gives an empty table.
    """
    require(conversations, "conv_id", "turn", "role", "text")
    turn = F.struct(
        F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    rows = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    rows = rows.withColumn("turns", F.expr("transform(turns, t -> named_struct('role', t.role, 'text', t.text))"))
    rows = rows.withColumn("__0", F.expr(_rendered("turns", "false")))
    rows = rows.withColumn("__differ", F.expr(
        f"CASE WHEN {_same('__0')} THEN NULL"
        f" ELSE transform({_parsed('__0')}, (p, i) -> i >= size(turns) OR p != try_element_at(turns, i + 1)) END"
    ))
    rows = rows.withColumn("__1", F.expr(
        f"CASE WHEN __differ IS NOT NULL THEN {_rendered('turns', 'coalesce(try_element_at(__differ, i + 1), true)')} END"
    ))
    rows = rows.withColumn("__good", F.expr(f"CASE WHEN __differ IS NOT NULL THEN {_same('__1')} END"))
    rows = rows.withColumn("rounds", F.expr("CASE WHEN __differ IS NULL THEN 0 WHEN __good THEN 1 ELSE 2 END"))
    rows = rows.withColumn("formatted", F.expr(
        f"CASE rounds WHEN 0 THEN __0 WHEN 1 THEN __1 ELSE {_rendered('turns', 'true')} END"
    ))
    parsed = rows.withColumn("parsed", F.expr(_parsed("formatted"))).withColumn("__bodies", F.expr(_bodies("formatted")))
    loss = f"transform(filter(__bodies, b -> b.role = '{LEARNT}'), b -> {unescape('b.text')})"
    return parsed.withColumn("__ends", F.expr(_ends())).select(
        "conv_id", "turns", "formatted", "rounds", "parsed", _spans().alias("loss_spans"), F.expr(loss).alias("loss_texts")
    )


_LENGTH = (
    f"(CASE WHEN b.role = 'user' THEN {len(OPEN_USER) + len(CLOSE_USER)} ELSE char_length(b.role) + {len(OPEN) + len(CLOSE) + 1} END"
    " + char_length(b.text))"
)


def _ends() -> str:
    """SQL for the end of every turn in the formatted text: running sums of the lengths that were read.

    Sums over 1, 2, 4, ... turns are added up, so the work grows hardly faster than the turns.
    """
    step = "CAST(power(2, s) AS INT)"
    add = f"transform(a, (x, i) -> x + coalesce(CASE WHEN i >= {step} THEN get(a, i - {step}) END, 0))"
    lengths = f"transform(__bodies, b -> coalesce({_LENGTH}, 0))"
    return f"aggregate(sequence(0, 30), {lengths}, (a, s) -> CASE WHEN {step} < size(a) THEN {add} ELSE a END)"


def _spans() -> Column:
    """Where the assistant texts lie in the formatted text."""
    start = f"get(__ends, i) - {_LENGTH} + char_length(b.role) + {len(OPEN) + 1}"
    span = f"named_struct('start', {start}, 'end', {start} + char_length(b.text))"
    spans = f"transform(__bodies, (b, i) -> CASE WHEN b.role = '{LEARNT}' THEN {span} END)"
    return F.expr(f"filter({spans}, s -> s IS NOT NULL)")


def digests(rows: DataFrame) -> DataFrame:
    """Checksums of formatted conversations, taken from the formatted text alone."""
    read = rows.withColumn("__loss", F.array_join("loss_texts", ""))
    turns = r"array_join(transform(parsed, p -> concat(p.role, '\n', p.text, '\n')), '')"
    return read.select(
        "conv_id",
        F.size("parsed").cast("long").alias("n_turns"),
        F.sha2(F.expr(turns), 256).alias("turns_sha256"),
        F.char_length("__loss").cast("long").alias("loss_chars"),
        F.sha2("__loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        "rounds",
    )
