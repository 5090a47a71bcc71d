"""Queries over conversations and call logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from orrery.functions.text import clean_file_name
from orrery.operators import records as R
from orrery.plans.registry import Tables, query
from orrery.plans.texts import strip_sql


@query(
    """SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY role <> 'system', turn) AS BIGINT) AS message_no, role, text
    FROM conversations"""
)
def transcript(spark, sf):
    return R.transcript(Tables(spark, sf).conversations)


# Which call an event stands for; errors are no call at all.
def _tool(kind: Column, k: Column) -> Column:
    return (
        F.when(kind == "signup", "save_personal_info")
        .when(kind == "purchase", "add_experience")
        .when((kind == "view") & (k % 2 == 0), "add_project")
        .when(kind == "view", "add_education")
        .when((kind == "click") & (k % 3 == 0), "save_summary")
        .when((kind == "click") & (k % 3 == 1), "add_hobbies")
        .when(kind == "click", "add_skills")
        .otherwise(kind)
    )


_TOOL = """CASE WHEN event_type = 'signup' THEN 'save_personal_info' WHEN event_type = 'purchase' THEN 'add_experience'
    WHEN event_type = 'view' AND k % 2 = 0 THEN 'add_project' WHEN event_type = 'view' THEN 'add_education'
    WHEN event_type = 'click' AND k % 3 = 0 THEN 'save_summary' WHEN event_type = 'click' AND k % 3 = 1 THEN 'add_hobbies'
    WHEN event_type = 'click' THEN 'add_skills' ELSE event_type END"""


def calls(t: Tables) -> DataFrame:
    """The events of a user as the calls that fill that user's record."""
    k = F.from_json("props", "k bigint")["k"]
    e = t.events.select("user_id", F.col("event_id").alias("seq"), "event_type", k.alias("k"))
    e = e.withColumn("tool", _tool(F.col("event_type"), F.col("k")))
    num, seq = F.col("k").cast("string"), F.col("seq").cast("string")

    def word(prefix: str, x: Column = num) -> Column:
        return F.concat(F.lit(prefix), x)

    fields = {
        "name": F.when(F.col("tool") == "add_project", word("project ")).otherwise(word("user ", F.col("user_id").cast("string"))),
        "email": F.concat(F.lit("u"), num, F.lit("@example.com")),
        "phone": seq,
        "location": word("city "),
        "linkedin": F.when(F.col("k") % 4 == 0, F.lit("")).otherwise(word("in/")),
        "summary": F.when(F.col("k") % 9 == 0, F.lit("")).otherwise(word("summary ")),
        "hobbies": word("hobby "),
        "company": word("company "),
        "position": word("position ", seq),
        "start_date": word("20"),
        "end_date": word("21"),
        "responsibilities": word("work "),
        "institution": word("school "),
        "degree": word("degree "),
        "field": word("field "),
        "graduation_date": word("19"),
        "gpa": F.when(F.col("k") % 3 == 0, F.lit("")).otherwise(num),
        "description": word("about ", seq),
        "technologies": word("tool "),
        "skills": F.concat(F.lit("skill "), num, F.lit(" , skill "), (F.col("k") % 7).cast("string")),
    }
    pairs = [x for name, value in fields.items() for x in (F.lit(name), value)]
    return e.select("user_id", "seq", "tool", F.create_map(*pairs).alias("args"))


_CALLS = f"""calls AS (SELECT *, CASE WHEN tool = 'add_project' THEN 'project ' || k ELSE 'user ' || user_id END AS name,
    'u' || k || '@example.com' AS email, CAST(seq AS VARCHAR) AS phone, 'city ' || k AS location, CASE WHEN k % 4 = 0 THEN '' ELSE 'in/' || k END AS linkedin,
    CASE WHEN k % 9 = 0 THEN '' ELSE 'summary ' || k END AS summary, 'hobby ' || k AS hobbies FROM
    (SELECT user_id, event_id AS seq, k, {_TOOL} AS tool FROM (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events) e) t)"""

_LAST = """last AS (SELECT user_id, max_by(name, seq) FILTER (tool = 'save_personal_info') AS name, max_by(email, seq) FILTER (tool = 'save_personal_info') AS email,
    max_by(phone, seq) FILTER (tool = 'save_personal_info') AS phone, max_by(location, seq) FILTER (tool = 'save_personal_info') AS location,
    max_by(linkedin, seq) FILTER (tool = 'save_personal_info') AS linkedin, max_by(summary, seq) FILTER (tool = 'save_summary') AS summary,
    max_by(hobbies, seq) FILTER (tool = 'add_hobbies') AS hobbies FROM calls GROUP BY 1)"""

_ENTRIES = """entries AS (SELECT user_id, CASE tool WHEN 'add_experience' THEN 'experience' WHEN 'add_education' THEN 'education' ELSE 'projects' END AS section,
    row_number() OVER (PARTITION BY user_id, tool ORDER BY seq) AS entry_no, seq, k, name FROM calls WHERE tool IN ('add_experience', 'add_education', 'add_project'))"""

_SKILLS = """skills AS (SELECT DISTINCT user_id, skill FROM (SELECT user_id, unnest(['skill ' || k, 'skill ' || (k % 7)]) AS skill FROM calls WHERE tool = 'add_skills') s)"""


@query(f"WITH {_CALLS}, {_LAST} SELECT * FROM last")
def last_write_wins(spark, sf):
    return R.last_write_wins(calls(Tables(spark, sf)), "user_id")


@query(
    f"""WITH {_CALLS}, {_ENTRIES} SELECT user_id, section, entry_no, CASE section WHEN 'experience' THEN 'position ' || seq || ' at company ' || k
    WHEN 'education' THEN 'degree ' || k || ' in field ' || k ELSE name || ': about ' || seq END AS title FROM entries"""
)
def append_sections(spark, sf):
    rows = R.append_sections(calls(Tables(spark, sf)), "user_id")
    a = F.col("args")
    title = (
        F.when(F.col("section") == "experience", F.concat(a["position"], F.lit(" at "), a["company"]))
        .when(F.col("section") == "education", F.concat(a["degree"], F.lit(" in "), a["field"]))
        .otherwise(F.concat(a["name"], F.lit(": "), a["description"]))
    )
    return rows.select("user_id", "section", "entry_no", title.alias("title"))


@query(
    f"""SELECT DISTINCT conv_id, skill FROM (SELECT conv_id, {strip_sql('x')} AS skill FROM
    (SELECT conv_id, unnest(string_split(text, ',')) AS x FROM conversations) a) b"""
)
def skill_set(spark, sf):
    """The comma-separated parts of all messages of a conversation."""
    return R.split_set(Tables(spark, sf).conversations, ["conv_id"], "text")


@query(f"WITH {_CALLS}, {_SKILLS} SELECT user_id, skill FROM skills")
def skills_from_calls(spark, sf):
    """The skills that the calls add to each record."""
    return R.skill_set(calls(Tables(spark, sf)), "user_id")


@query(
    f"""WITH {_CALLS}, {_LAST}, {_SKILLS}, c AS (SELECT user_id, count(*) FILTER (tool = 'save_personal_info') > 0 AS personal_info,
    count(*) FILTER (tool = 'add_experience') AS experience, count(*) FILTER (tool = 'add_education') AS education, count(*) FILTER (tool = 'add_project') AS projects FROM calls GROUP BY 1),
    r AS (SELECT c.user_id, personal_info, coalesce(summary <> '', false) AS summary, experience, education,
    (SELECT count(*) FROM skills s WHERE s.user_id = c.user_id) AS skills, coalesce(hobbies <> '', false) AS hobbies, projects FROM c JOIN last ON c.user_id = last.user_id)
    SELECT *, '{{"personal_info": ' || personal_info || ', "summary": ' || summary || ', "experience": ' || experience || ', "education": ' || education
    || ', "skills": ' || skills || ', "hobbies": ' || hobbies || ', "projects": ' || projects || '}}' AS status FROM r"""
)
def completeness(spark, sf):
    return R.completeness(calls(Tables(spark, sf)), "user_id")


_N = "chr(10)"
_BODY = f"""texts AS (SELECT user_id, section, string_agg(CASE section
    WHEN 'experience' THEN 'position ' || seq || ' | company ' || k || {_N} || '20' || k || ' - 21' || k || {_N} || 'work ' || k || {_N}
    WHEN 'education' THEN 'degree ' || k || ' in field ' || k || {_N} || 'school ' || k || ' | 19' || k || CASE WHEN k % 3 = 0 THEN '' ELSE {_N} || 'GPA: ' || k END || {_N}
    ELSE name || {_N} || 'about ' || seq || {_N} || 'Technologies: tool ' || k || {_N} END, {_N} ORDER BY entry_no) AS body FROM entries GROUP BY 1, 2),
    listed AS (SELECT user_id, string_agg(skill, ', ' ORDER BY skill) AS body FROM skills GROUP BY 1),
    users AS (SELECT user_id, bool_or(tool = 'save_personal_info') AS has_person FROM calls GROUP BY 1)"""


def _section_sql(title: str, body: str) -> str:
    return f"CASE WHEN {body} <> '' THEN '{title}' || {_N} || repeat('-', 60) || {_N} || {body} || {_N} END"


def _entry_sql(title: str, section: str) -> str:
    return f"(SELECT '{title}' || {_N} || repeat('-', 60) || {_N} || body FROM texts t WHERE t.user_id = u.user_id AND section = '{section}')"


@query(
    f"""WITH {_CALLS}, {_LAST}, {_ENTRIES}, {_SKILLS}, {_BODY},
    whole AS (SELECT u.user_id, concat_ws({_N}, CASE WHEN has_person THEN {_N} || repeat('=', 60) || {_N} || upper(l.name) || {_N} || email || ' | ' || phone || ' | ' || location || {_N}
    || CASE WHEN linkedin <> '' THEN 'LinkedIn: ' || linkedin || {_N} ELSE '' END || repeat('=', 60) || {_N} END,
    {_section_sql('PROFESSIONAL SUMMARY', 'summary')}, {_entry_sql('WORK EXPERIENCE', 'experience')}, {_entry_sql('EDUCATION', 'education')},
    {_section_sql('SKILLS', 's.body')}, {_entry_sql('PROJECTS', 'projects')}, {_section_sql('HOBBIES & INTERESTS', 'hobbies')}) AS resume
    FROM users u JOIN last l ON l.user_id = u.user_id LEFT JOIN listed s ON s.user_id = u.user_id)
    SELECT user_id, CASE WHEN resume = '' THEN 'Your resume is empty. Let''s start building it!' ELSE resume END AS resume FROM whole"""
)
def render_record(spark, sf):
    return R.render_record(calls(Tables(spark, sf)), "user_id")


@query(
    f"WITH {_CALLS} SELECT tool, count(*) AS calls, tool <> 'error' AS known FROM calls GROUP BY 1"
)
def tool_dispatch_count(spark, sf):
    return R.tool_dispatch_count(calls(Tables(spark, sf)))


@query(
    r"""SELECT event_id, regexp_replace(event_type || ' №' || user_id || ': ' || props, '[^\p{L}\p{N}_-]', '_', 'g') || '_' || strftime(ts, '%Y%m%d_%H%M%S') || '.png' AS file_name
    FROM events"""
)
def clean_filename(spark, sf):
    name = F.concat(F.col("event_type"), F.lit(" №"), F.col("user_id").cast("string"), F.lit(": "), F.col("props"))
    stamp = F.date_format("ts", "yyyyMMdd_HHmmss")
    return Tables(spark, sf).events.select(
        "event_id", F.concat(clean_file_name(name), F.lit("_"), stamp, F.lit(".png")).alias("file_name")
    )


@query(
    """SELECT user_id, entry_no, chr(10) || entry_no || '. Style: ' || event_type || chr(10) || '   File: file_' || event_id || chr(10) || '   Prompt: ' ||
    substr(repeat(props, 10), 1, 80) || '...' || chr(10) || '   Time: ' || strftime(ts, '%Y-%m-%dT%H:%M:%S') ||
    CASE WHEN microsecond(ts) % 1000000 = 0 THEN '' ELSE '.' || strftime(ts, '%f') END || chr(10) AS listing
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS entry_no FROM events) t"""
)
def log_listing(spark, sf):
    log = Tables(spark, sf).events.select(
        "user_id", "event_id", "event_type", F.concat(F.lit("file_"), F.col("event_id").cast("string")).alias("file"),
        F.repeat("props", 10).alias("prompt"), "ts",
    )
    return R.log_listing(
        log, "user_id", "event_id", {"style": "event_type", "file": "file", "prompt": "prompt", "time": "ts"}
    )
