"""Conversations and call logs folded into one record per key.

A call log has one row per call: record key, `seq` (unique and growing within a record), `tool`,
and `args`, a map of strings. Growing sections stay rows, so a record with very many
calls is no single task; only a rendered record is one value."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from orrery.functions.text import iso_time, preview, strip
from orrery.operators.ordered import BUCKET, MAX_BUCKETS, bucket_by_range, dense_index

# Calls, and the fields each one takes.
TOOL_FIELDS = {
    "save_personal_info": ["name", "email", "phone", "location", "linkedin"],
    "save_summary": ["summary"],
    "add_experience": ["company", "position", "start_date", "end_date", "responsibilities"],
    "add_education": ["institution", "degree", "field", "graduation_date", "gpa"],
    "add_skills": ["skills"],
    "add_hobbies": ["hobbies"],
    "add_project": ["name", "description", "technologies"],
}
OTHER_TOOLS = ["search", "check_resume_completeness", "generate_resume"]
APPENDED = {"add_experience": "experience", "add_education": "education", "add_project": "projects"}
EMPTY_RECORD = "Your resume is empty. Let's start building it!"


def transcript(messages: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Messages numbered within each conversation, system messages first."""
    system = F.col("role") == "system"
    ranged = bucket_by_range(messages, turn)
    # System messages take the buckets below all others.
    ranged = ranged.withColumn("__after", F.when(system, 0).otherwise(1)).withColumn(
        BUCKET, F.when(system, F.col(BUCKET) - 2 * MAX_BUCKETS).otherwise(F.col(BUCKET))
    )
    numbered = dense_index(ranged, ["__after", turn], "message_no", keys=[conv], bucket=BUCKET)
    return numbered.select(conv, "message_no", "role", "text")


def _latest(calls: DataFrame, record: str, seq: str) -> DataFrame:
    """The arguments of the latest call of each kind that overwrites: `p`, `s` and `h`."""

    def latest(tool: str) -> Column:
        return F.max_by("args", F.when(F.col("tool") == tool, F.col(seq)))

    return calls.groupBy(record).agg(
        latest("save_personal_info").alias("p"),
        latest("save_summary").alias("s"),
        latest("add_hobbies").alias("h"),
    )


def _details() -> list[Column]:
    person = [F.col("p")[f].alias(f) for f in TOOL_FIELDS["save_personal_info"]]
    return [*person, F.col("s")["summary"].alias("summary"), F.col("h")["hobbies"].alias("hobbies")]


def last_write_wins(calls: DataFrame, record: str, seq: str = "seq") -> DataFrame:
    """The latest personal details, summary and hobbies of each record."""
    return _latest(calls, record, seq).select(record, *_details())


def append_sections(calls: DataFrame, record: str, seq: str = "seq") -> DataFrame:
    """Experience, education and project entries, numbered per record and section in
    call order."""
    section = F.lit(None).cast("string")
    for tool, name in APPENDED.items():
        section = F.when(F.col("tool") == tool, F.lit(name)).otherwise(section)
    entries = calls.withColumn("section", section).where(F.col("section").isNotNull())
    entries = entries.select(record, "section", seq, "args")
    numbered = dense_index(
        bucket_by_range(entries, seq), [seq], "entry_no", keys=[record, "section"], bucket=BUCKET
    )
    return numbered.select(record, "section", "entry_no", "args")


def split_set(df: DataFrame, keys: Sequence[str], col: str, out: str = "skill") -> DataFrame:
    """Distinct trimmed parts of comma-separated lists, one row each."""
    parts = df.select(*keys, F.explode(F.split(F.col(col), ",")).alias(out))
    return parts.select(*keys, strip(F.col(out)).alias(out)).distinct()


def skill_set(calls: DataFrame, record: str) -> DataFrame:
    """The skills of each record, one row each."""
    added = calls.where("tool = 'add_skills'").select(record, F.col("args")["skills"].alias("skills"))
    return split_set(added, [record], "skills")


def completeness(calls: DataFrame, record: str, seq: str = "seq") -> DataFrame:
    """Which sections each record has, and how many entries, also as JSON."""

    def count(tool: str) -> Column:
        return F.count_if(F.col("tool") == tool)

    def latest_text(tool: str, field: str) -> Column:
        text = F.max_by(F.col("args")[field], F.when(F.col("tool") == tool, F.col(seq)))
        return F.coalesce(text != "", F.lit(False))

    sums = calls.groupBy(record).agg(
        (count("save_personal_info") > 0).alias("personal_info"),
        latest_text("save_summary", "summary").alias("summary"),
        count("add_experience").alias("experience"),
        count("add_education").alias("education"),
        latest_text("add_hobbies", "hobbies").alias("hobbies"),
        count("add_project").alias("projects"),
    )
    skills = skill_set(calls, record).groupBy(record).agg(F.count(F.lit(1)).alias("skills"))
    fields = ["personal_info", "summary", "experience", "education", "skills", "hobbies", "projects"]
    merged = sums.join(skills, record, "left").withColumn("skills", F.coalesce("skills", F.lit(0)))
    parts = [F.concat(F.lit(f'"{f}": '), F.col(f).cast("string")) for f in fields]
    status = F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))
    return merged.select(record, *fields, status.alias("status"))


def tool_dispatch_count(calls: DataFrame, tool: str = "tool", known: Sequence[str] | None = None) -> DataFrame:
    """Calls per tool; names that are no tool are counted too, marked as unknown."""
    names = [*TOOL_FIELDS, *OTHER_TOOLS] if known is None else list(known)
    return (
        calls.groupBy(F.col(tool).alias("tool"))
        .agg(F.count(F.lit(1)).alias("calls"))
        .withColumn("known", F.col("tool").isin(names))
    )


RULE = "-" * 60
BORDER = "=" * 60
ENTRY_BLOCK = 256  # entries joined in one task before the record text

# Section titles in their order.
SECTION_TITLES = {
    "summary": "PROFESSIONAL SUMMARY",
    "experience": "WORK EXPERIENCE",
    "education": "EDUCATION",
    "skills": "SKILLS",
    "projects": "PROJECTS",
    "hobbies": "HOBBIES & INTERESTS",
}


def _entry_text(args: Column) -> dict[str, Column]:
    """Lines of one appended entry; the empty line after it is part of it."""

    def f(name: str) -> Column:
        return F.coalesce(args[name], F.lit(""))

    gpa = F.when(f("gpa") != "", F.concat(F.lit("\nGPA: "), f("gpa"))).otherwise(F.lit(""))
    return {
        "experience": F.concat(
            f("position"), F.lit(" | "), f("company"), F.lit("\n"), f("start_date"), F.lit(" - "), f("end_date"),
            F.lit("\n"), f("responsibilities"), F.lit("\n"),
        ),
        "education": F.concat(
            f("degree"), F.lit(" in "), f("field"), F.lit("\n"), f("institution"), F.lit(" | "),
            f("graduation_date"), gpa, F.lit("\n"),
        ),
        "projects": F.concat(
            f("name"), F.lit("\n"), f("description"), F.lit("\nTechnologies: "), f("technologies"), F.lit("\n")
        ),
    }


def _joined(order: str, text: str, sep: str) -> Column:
    rows = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t"))))
    return F.array_join(F.transform(rows, lambda r: r["t"]), sep)


def _join_entries(rows: DataFrame, keys: list[str], order: str, text: str, sep: str) -> DataFrame:
    """Ordered texts of each key as one text, block by block first."""
    block = F.floor(F.col(order) / ENTRY_BLOCK).alias("__block")
    blocks = rows.groupBy(*keys, block).agg(_joined(order, text, sep).alias("__t"))
    return blocks.groupBy(*keys).agg(_joined("__block", "__t", sep).alias(text))


def render_record(calls: DataFrame, record: str, seq: str = "seq") -> DataFrame:
    """The record as text, section by section, empty sections left out. Skills are listed in
    text order."""
    last = _latest(calls, record, seq).select(record, F.col("p").isNotNull().alias("has_person"), *_details())

    def f(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(""))

    linkedin = F.when(f("linkedin") != "", F.concat(F.lit("LinkedIn: "), f("linkedin"), F.lit("\n"))).otherwise("")
    person = F.when(
        F.col("has_person"),
        F.concat(
            F.lit(f"\n{BORDER}\n"), F.upper(f("name")), F.lit("\n"), f("email"), F.lit(" | "), f("phone"),
            F.lit(" | "), f("location"), F.lit("\n"), linkedin, F.lit(f"{BORDER}\n"),
        ),
    )

    def titled(section: str, body: Column) -> Column:
        return F.when(body != "", F.concat(F.lit(f"{SECTION_TITLES[section]}\n{RULE}\n"), body, F.lit("")))

    entries = append_sections(calls, record, seq)
    text = F.lit(None).cast("string")
    for name, lines in _entry_text(F.col("args")).items():
        text = F.when(F.col("section") == name, lines).otherwise(text)
    entry_texts = _join_entries(
        entries.withColumn("text", text), [record, "section"], "entry_no", "text", "\n"
    )
    by_section = entry_texts.groupBy(record).agg(
        *[F.max(F.when(F.col("section") == s, F.col("text"))).alias(f"t_{s}") for s in APPENDED.values()]
    )
    skills = skill_set(calls, record)
    # Skills are joined range by range of their first letters, then record by record.
    letters = F.substring("skill", 1, 2)
    skill_text = (
        skills.groupBy(record, letters.alias("__block"))
        .agg(_joined("skill", "skill", ", ").alias("__t"))
        .groupBy(record)
        .agg(_joined("__block", "__t", ", ").alias("t_skills"))
    )
    all_parts = last.join(by_section, record, "left").join(skill_text, record, "left")
    body = {
        "summary": F.concat(f("summary"), F.when(f("summary") != "", F.lit("\n")).otherwise("")),
        "experience": f("t_experience"),
        "education": f("t_education"),
        "skills": F.concat(f("t_skills"), F.when(f("t_skills") != "", F.lit("\n")).otherwise("")),
        "projects": f("t_projects"),
        "hobbies": F.concat(f("hobbies"), F.when(f("hobbies") != "", F.lit("\n")).otherwise("")),
    }
    sections = [person, *[titled(s, body[s]) for s in SECTION_TITLES]]
    whole = F.concat_ws("\n", *sections)
    return all_parts.select(
        record, F.when(whole == "", F.lit(EMPTY_RECORD)).otherwise(whole).alias("resume")
    )


def log_listing(
    log: DataFrame, session: str, order: str, fields: Mapping[str, str]
) -> DataFrame:
    """Numbered listing entries per session: style, file, prompt start and time. `fields`
    names the columns for `style`, `file`, `prompt` and `time`; `order` is numeric and unique."""
    numbered = dense_index(bucket_by_range(log, order), [order], "entry_no", keys=[session], bucket=BUCKET)
    listing = F.concat(
        F.lit("\n"), F.col("entry_no").cast("string"), F.lit(". Style: "), F.col(fields["style"]),
        F.lit("\n   File: "), F.col(fields["file"]),
        F.lit("\n   Prompt: "), preview(F.col(fields["prompt"]), 80),
        F.lit("\n   Time: "), iso_time(F.col(fields["time"])), F.lit("\n"),
    )
    return numbered.select(session, "entry_no", listing.alias("listing"))
