"""Records from call logs, and conversations."""

import json

import pytest
from pyspark.sql import functions as F

from orrery.operators import records as R

CALLS = [
    (1, 1, "save_personal_info", {"name": "Ann", "email": "a@x", "phone": "1", "location": "T", "linkedin": ""}),
    (1, 2, "add_skills", {"skills": "sql, spark ,sql"}),
    (1, 3, "add_experience", {"company": "C", "position": "P", "start_date": "1", "end_date": "2", "responsibilities": "r"}),
    (1, 4, "save_personal_info", {"name": "Ann B", "email": "b@x", "phone": "2", "location": "U", "linkedin": "in/a"}),
    (1, 5, "add_experience", {"company": "D", "position": "Q", "start_date": "3", "end_date": "4", "responsibilities": "s"}),
    (1, 6, "add_education", {"institution": "I", "degree": "BSc", "field": "F", "graduation_date": "9", "gpa": "5"}),
    (1, 7, "add_project", {"name": "N", "description": "d", "technologies": "t"}),
    (1, 8, "save_summary", {"summary": "old"}),
    (1, 9, "save_summary", {"summary": "new"}),
    (1, 10, "add_hobbies", {"hobbies": "chess"}),
    (1, 11, "add_skills", {"skills": "java"}),
    (1, 12, "fly", {}),
    (2, 1, "search", {}),
]


@pytest.fixture(scope="module", params=[1, 6])
def calls(spark, request):
    schema = "rec int, seq bigint, tool string, args map<string,string>"
    return spark.createDataFrame(CALLS, schema).repartition(request.param)


def test_last_write_wins(calls):
    got = {r["rec"]: r for r in R.last_write_wins(calls, "rec").collect()}
    assert (got[1]["name"], got[1]["linkedin"], got[1]["summary"], got[1]["hobbies"]) == ("Ann B", "in/a", "new", "chess")
    assert (got[2]["name"], got[2]["summary"]) == (None, None)


def test_append_sections(calls):
    got = [(r["section"], r["entry_no"], r["args"].get("company")) for r in R.append_sections(calls, "rec").collect()]
    assert sorted(got, key=str) == sorted(
        [("experience", 1, "C"), ("experience", 2, "D"), ("education", 1, None), ("projects", 1, None)], key=str
    )


def test_skills_and_completeness(calls, rows):
    assert rows(R.skill_set(calls, "rec")) == [(1, "java"), (1, "spark"), (1, "sql")]
    got = {r["rec"]: json.loads(r["status"]) for r in R.completeness(calls, "rec").collect()}
    assert got[1] == {
        "personal_info": True, "summary": True, "experience": 2, "education": 1, "skills": 3, "hobbies": True, "projects": 1,
    }
    assert got[2] == {
        "personal_info": False, "summary": False, "experience": 0, "education": 0, "skills": 0, "hobbies": False, "projects": 0,
    }


def test_render(calls):
    got = {r["rec"]: r["resume"] for r in R.render_record(calls, "rec").collect()}
    rule, border = "-" * 60, "=" * 60
    assert got[1].split("\n") == [
        "", border, "ANN B", "b@x | 2 | U", "LinkedIn: in/a", border, "",
        "PROFESSIONAL SUMMARY", rule, "new", "",
        "WORK EXPERIENCE", rule, "P | C", "1 - 2", "r", "", "Q | D", "3 - 4", "s", "",
        "EDUCATION", rule, "BSc in F", "I | 9", "GPA: 5", "",
        "SKILLS", rule, "java, spark, sql", "",
        "PROJECTS", rule, "N", "d", "Technologies: t", "",
        "HOBBIES & INTERESTS", rule, "chess", "",
    ]
    assert got[2] == R.EMPTY_RECORD


def test_tool_counts(calls, rows):
    got = {r["tool"]: (r["calls"], r["known"]) for r in R.tool_dispatch_count(calls).collect()}
    assert got["fly"] == (1, False) and got["search"] == (1, True) and got["add_skills"] == (2, True)


def test_entries_of_a_large_record(spark):
    """More entries than one block; they stay in call order."""
    rows = spark.range(700).select(
        F.lit(1).alias("rec"), F.col("id").alias("seq"), F.lit("add_project").alias("tool"),
        F.create_map(F.lit("name"), F.concat(F.lit("n"), F.col("id"))).alias("args"),
    )
    text = R.render_record(rows.repartition(5), "rec").first()["resume"]
    assert [x for x in text.split("\n") if x.startswith("n")] == [f"n{i}" for i in range(700)]


def test_transcript_puts_system_first(spark):
    data = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 2, "system", "s"), (2, 5, "user", "x"), (2, 9, "user", "y")]
    df = spark.createDataFrame(data, "conv_id int, turn int, role string, text string").repartition(3)
    out = R.transcript(df).orderBy("conv_id", "message_no").collect()
    assert [(r["conv_id"], r["message_no"], r["text"]) for r in out] == [(1, 1, "s"), (1, 2, "a"), (1, 3, "b"), (2, 1, "x"), (2, 2, "y")]
