"""Registered queries: profile matching and text weights."""

from __future__ import annotations

from pyspark.sql import functions as F

from vacancia.operators import matching
from vacancia.operators.text import tfidf
from vacancia.plans import shared as q
from vacancia.plans import standins as s
from vacancia.plans.master import etl_salary
from vacancia.plans.registry import query, rounded, with_

# The profile of a single user, in the user's words.
_USER = ["brand#11", "BRAND#2", "excel sheets", "Brand#25"]
_USER_ALIASES = {"Brand#7": ["excel", "sql"], "Brand#9": ["python"]}


def _jobs(spark, d):
    """Postings with their yearly salary and skill set."""
    posts = etl_salary(s.postings(spark, d)).select(
        "job_id", "formatted_experience_level", "formatted_work_type", "normalized_salary"
    )
    return matching.job_skill_sets(posts, s.job_skills(spark, d), s.skills(spark, d))


def _profiles(spark, d):
    return matching.map_skills(s.profile_words(spark, d), s.skills(spark, d), s.PROFILE_ALIASES)


@query(
    "filtered_jobs",
    "J1 C7",
    with_(
        q.P,
        select="""SELECT job_id FROM p WHERE lower(formatted_experience_level) LIKE '%mid-senior level%'
  AND lower(formatted_work_type) LIKE '%time%'""",
    ),
)
def filtered_jobs(spark, d):
    return matching.prefilter(s.postings(spark, d), "Mid-Senior Level", work_type="TIME").select("job_id")


@query("mapped_profiles", "J2", f"WITH {s.PROFILE_SQL} SELECT profile_id, skill_name FROM mapped")
def mapped_profiles(spark, d):
    return _profiles(spark, d)


@query(
    "one_profile_scores",
    "J1 J3 J4 D16",
    with_(
        q.P,
        q.JOB_SKILLS,
        "me(skill) AS (VALUES ('Brand#11'), ('Brand#2'), ('Brand#25'), ('Brand#7'))",
        "ds AS (SELECT DISTINCT job_id, skill_abr FROM job_skills)",
        """sc AS (SELECT job_id, count(me.skill) AS c, count(skill_abr) AS b,
    string_agg(skill_abr, '|' ORDER BY skill_abr) AS required,
    string_agg(skill_abr, '|' ORDER BY skill_abr) FILTER (WHERE me.skill IS NULL) AS missing
  FROM ds LEFT JOIN me ON me.skill = skill_abr GROUP BY job_id)""",
        select="""SELECT p.job_id, round(COALESCE(c, 0) / CAST(4 + COALESCE(b, 0) - COALESCE(c, 0) AS DOUBLE), 4)
    AS matching_score, COALESCE(required, '') AS required_skills, COALESCE(missing, '') AS missing_skills
  FROM p LEFT JOIN sc USING (job_id) WHERE lower(formatted_experience_level) LIKE '%mid-senior level%'""",
    ),
)
def one_profile_scores(spark, d):
    """One user's profile against every job of the wanted level, jobs without a common skill included."""
    words = spark.createDataFrame([(1, w) for w in _USER], "profile_id bigint, skill string")
    me = matching.map_skills(words, s.skills(spark, d), _USER_ALIASES)
    scored = matching.score_jobs(me, matching.prefilter(_jobs(spark, d), "Mid-Senior Level"))
    return scored.select(
        "job_id",
        "matching_score",
        F.array_join("required_skills", "|").alias("required_skills"),
        F.array_join("missing_skills", "|").alias("missing_skills"),
    )


# Every profile counts, also one none of whose words names a skill (a = 0).
_SCORES = """ds AS (SELECT DISTINCT job_id, skill_abr FROM job_skills),
bs AS (SELECT job_id, count(*) AS b FROM ds GROUP BY 1),
ms AS (SELECT profile_id, count(skill_name) AS a
  FROM (SELECT DISTINCT profile_id FROM words) LEFT JOIN mapped USING (profile_id) GROUP BY 1),
pairs AS (SELECT profile_id, job_id, count(*) AS c FROM mapped JOIN ds ON skill_abr = skill_name GROUP BY 1, 2),
scores AS (SELECT profile_id, job_id, c / CAST(a + b - c AS DOUBLE) AS score
  FROM pairs JOIN ms USING (profile_id) JOIN bs USING (job_id))"""


@query(
    "top_matches_per_profile",
    "J3 J4 J5",
    f"WITH {q.P}, {q.JOB_SKILLS}, {s.PROFILE_SQL}, {_SCORES},"
    """
fill AS (SELECT profile_id, job_id, 0.0 AS score FROM ms, (SELECT job_id FROM p ORDER BY job_id LIMIT 10)),
listed AS (SELECT profile_id, job_id, max(score) AS score
  FROM (SELECT * FROM scores UNION ALL SELECT * FROM fill) GROUP BY 1, 2),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY profile_id ORDER BY score DESC, job_id) AS rn FROM listed)
  WHERE rn <= 5)
SELECT profile_id, job_id, round(score, 4) AS matching_score,
  COALESCE((SELECT string_agg(skill_abr, '|' ORDER BY skill_abr) FROM ds WHERE ds.job_id = best.job_id), '') AS required_skills,
  COALESCE((SELECT string_agg(skill_abr, '|' ORDER BY skill_abr) FROM ds WHERE ds.job_id = best.job_id AND skill_abr NOT IN
    (SELECT skill_name FROM mapped m WHERE m.profile_id = best.profile_id)), '') AS missing_skills FROM best""",
)
def top_matches_per_profile(spark, d):
    best = matching.top_matches(_profiles(spark, d), _jobs(spark, d), 5, everyone=s.profile_words(spark, d))
    return best.select(
        "profile_id",
        "job_id",
        F.round("score", 4).alias("matching_score"),
        F.array_join("required_skills", "|").alias("required_skills"),
        F.array_join("missing_skills", "|").alias("missing_skills"),
    )


@query(
    "salary_suggestions",
    "J6",
    f"WITH {q.P}, {q.PRICED}, {q.JOB_SKILLS}, {s.PROFILE_SQL}, {_SCORES},"
    """
pool AS (SELECT * FROM (
  SELECT profile_id, normalized_salary,
    row_number() OVER (PARTITION BY profile_id ORDER BY COALESCE(score, 0) DESC, job_id) AS rn
  FROM ms CROSS JOIN (SELECT job_id, normalized_salary FROM priced WHERE normalized_salary > 0)
    LEFT JOIN scores USING (profile_id, job_id)) WHERE rn <= 100)
SELECT profile_id, count(*) AS pool, round(quantile_cont(normalized_salary, 0.25), 4) AS suggested_min,
  round(quantile_cont(normalized_salary, 0.5), 4) AS suggested_median,
  round(quantile_cont(normalized_salary, 0.75), 4) AS suggested_max FROM pool GROUP BY 1""",
)
def salary_suggestions(spark, d):
    return rounded(matching.salary_suggestion(_profiles(spark, d), _jobs(spark, d), everyone=s.profile_words(spark, d)))


# --- text ---------------------------------------------------------------------------------


def _tfidf_sql(table: str, key: str, text: str, n: int, bigrams: bool, sublinear: bool, stop: list[str]) -> str:
    keep = f"list_filter(ws, lambda w: w NOT IN ({', '.join(repr(w) for w in stop)}))" if stop else "ws"
    grams = "list_concat(wl, list_transform(range(1, len(wl)), lambda i: wl[i] || ' ' || wl[i + 1]))"
    tf = "1 + ln(n)" if sublinear else "n"
    return f"""WITH words AS (
  SELECT {key} AS id, regexp_extract_all({'strip_accents(lower(' + text + '))' if sublinear else 'lower(' + text + ')'},
    '[\\p{{L}}\\p{{N}}_]{{2,}}') AS ws FROM {table}),
kept AS (SELECT id, {keep} AS wl FROM words),
grams AS (SELECT id, {grams if bigrams else 'wl'} AS g FROM kept),
terms AS (SELECT id, unnest(g) AS term FROM grams),
counts AS (SELECT id, term, count(*) AS n FROM terms GROUP BY 1, 2),
vocab AS (SELECT term, count(*) AS df FROM counts GROUP BY 1 ORDER BY sum(n) DESC, term LIMIT {n}),
raw AS (SELECT id, term, ({tf}) * (ln((1.0 + (SELECT count(*) FROM {table})) / (1 + df)) + 1) AS w
  FROM counts JOIN vocab USING (term))
SELECT id AS {key}, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY id)), 6) AS weight FROM raw"""


@query("document_tfidf", "K7", _tfidf_sql("documents", "doc_id", "text", 300, True, True, []))
def document_tfidf(spark, d):
    return rounded(tfidf(s.raw(spark, d, "documents"), "doc_id", "text", (1, 2), 300, True), 6)


@query("part_name_tfidf", "K7", _tfidf_sql("part", "p_partkey", "p_name", 300, True, True, []))
def part_name_tfidf(spark, d):
    return rounded(tfidf(s.raw(spark, d, "part"), "p_partkey", "p_name", (1, 2), 300, True), 6)


_STOP = ["the", "and", "of", "to", "in", "on", "le", "la", "les", "des", "un", "une", "que", "qui", "der", "die", "und"]


@query("document_tfidf_without_stop_words", "K8", _tfidf_sql("documents", "doc_id", "text", 500, False, False, _STOP))
def document_tfidf_without_stop_words(spark, d):
    docs = s.raw(spark, d, "documents")
    return rounded(tfidf(docs, "doc_id", "text", (1, 1), 500, False, accents=False, stop_words=_STOP), 6)


# Spark's English stop words, for the twin; the query asks Spark for its own list.
_ENGLISH = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself it its itself "
    "they them their theirs themselves what which who whom this that these those am is are was were be been being have has had having "
    "do does did doing a an the and but if or because as until while of at by for with about against between into through during before "
    "after above below to from up down in out on off over under again further then once here there when where why how all any both each "
    "few more most other some such no nor not only own same so than too very s t can will just don should now i'll you'll he'll she'll "
    "we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've you've they've isn't aren't "
    "wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't mustn't can't couldn't cannot could here's "
    "how's let's ought that's there's what's when's where's who's why's would"
).split()


@query(
    "document_tfidf_english",
    "K8",
    _tfidf_sql("documents", "doc_id", "text", 500, False, False, [w for w in _ENGLISH if "'" not in w]),  # no token has an apostrophe
)
def document_tfidf_english(spark, d):
    docs = s.raw(spark, d, "documents")
    return rounded(tfidf(docs, "doc_id", "text", (1, 1), 500, False, accents=False, stop_words="english"), 6)
