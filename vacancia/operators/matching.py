"""Candidate profiles against jobs by Jaccard similarity of their skill sets.

A score depends on the two skill sets alone, and there are far fewer sets than
jobs or profiles. So sets are compared, once each, and a set stands for its
first k jobs: jobs of one set tie, and ties go to the smaller job id, so no later
job of a set can enter a top k. Nothing is dropped by this; the lists are exact.
Sets of up to SMALL skills meet under the skills they share, in lists that hold the first
k sets each. Wider sets meet in an inverted index, asked only for the skills and set sizes
that a profile's kth best score, bounded from below beforehand, leaves possible.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancia.functions import contains_text
from vacancia.operators.children import child_set
from vacancia.operators.keys import first_per_key
from vacancia.sources.tables import stored

# Words that stand for a broad skill.
SKILL_ALIASES = {
    "Information Technology": ["python", "sql", "excel", "data", "software", "it", "code"],
}


def prefilter(
    jobs: DataFrame,
    experience: str | None = None,
    industry: str | None = None,
    work_type: str | None = None,
    literal: bool = False,
) -> DataFrame:
    """Jobs whose fields contain the given patterns, ignoring case; a pattern left out does not filter."""
    wanted = {
        "formatted_experience_level": experience,
        "primary_industry_name": industry,
        "formatted_work_type": work_type,
    }
    for col, pattern in wanted.items():
        if pattern:
            jobs = jobs.where(contains_text(col, pattern, literal))
    return jobs


def map_skills(
    profiles: DataFrame,
    skills: DataFrame,
    aliases: Mapping[str, Sequence[str]] = SKILL_ALIASES,
    match: str = "substring",
) -> DataFrame:
    """(profile_id, skill) in a user's words to distinct (profile_id, skill_name).

    A skill name counts when it equals the word ignoring case; an alias when it occurs
    in the word (``substring``) or is one of its tokens (``token``).
    """
    word = F.lower("skill")
    if match == "token":
        found = lambda k: F.array_contains(F.regexp_extract_all(word, F.lit(r"([\p{L}\p{N}_]+)"), F.lit(1)), k)
    elif match == "substring":
        found = lambda k: F.contains(word, F.lit(k))
    else:
        raise ValueError(f"match must be 'substring' or 'token', not {match!r}")
    exact = profiles.join(
        skills.select("skill_name").distinct(), word == F.lower("skill_name"), "inner"
    ).select("profile_id", "skill_name")
    hits: list[Column] = []
    for name, keywords in aliases.items():
        any_of = F.lit(False)
        for k in keywords:
            any_of = any_of | found(k.lower())
        hits.append(F.when(any_of, F.lit(name)))
    if hits:
        named = profiles.select("profile_id", F.explode(F.array_compact(F.array(*hits))).alias("skill_name"))
        exact = exact.unionByName(named)
    return exact.distinct()


def job_skill_sets(jobs: DataFrame, job_skills: DataFrame, skills: DataFrame) -> DataFrame:
    """Jobs with their sorted set of skill names; a job without skills has the empty set."""
    named = job_skills.join(skills, "skill_abr", "left").select("job_id", "skill_name")
    sets = child_set(named, "job_id", "skill_name", "required_skills")
    empty = F.array().cast("array<string>")
    return jobs.join(sets, "job_id", "left").withColumn(
        "required_skills", F.coalesce(F.col("required_skills"), empty)
    )


def jaccard(shared: Column, left: Column, right: Column) -> Column:
    """|A and B| / |A or B| from the three sizes; two empty sets score 0."""
    return F.coalesce(F.try_divide(shared, left + right - shared), F.lit(0.0))


def missing_skills(required: Column, have: Column) -> Column:
    return F.array_except(required, have)


def score_jobs(profile: DataFrame, jobs: DataFrame) -> DataFrame:
    """One profile's score for every job, zeros included. ``profile`` holds its ``skill_name`` rows.

    Linear in the jobs: the profile's set is one value, read once.
    """
    mine = profile.agg(F.array_sort(F.collect_set("skill_name")).alias("s")).scalar()
    scored = jobs.withColumn("_mine", mine)
    shared = F.size(F.array_intersect("required_skills", "_mine"))
    return scored.withColumns(
        {
            "matching_score": F.round(jaccard(shared, F.size("required_skills"), F.size("_mine")), 4),
            "missing_skills": missing_skills(F.col("required_skills"), F.col("_mine")),
        }
    ).drop("_mine")


BITS = 62
# Job sets per list and task: longer lists are dealt out.
LIST = 2_000


def _tasks(df: DataFrame) -> int:
    """Small rows with much work each: as many tasks as there are cores, whatever their size."""
    return 2 * df.sparkSession.sparkContext.defaultParallelism


def _all(conditions: Iterable[Column]) -> Column:
    return reduce(lambda x, y: x & y, conditions)


def _spread(df: DataFrame) -> DataFrame:
    """A side of a join that grows with the input: the join is dealt out by its keys and nothing goes by way of the driver.

    Spark takes an exploded or stored table for as large as the packed file it comes from, and would broadcast it for that.
    Only figures per skill are broadcast.
    """
    return df.hint("merge")


def _log_size(size: Column) -> Column:
    return F.floor(F.log2(F.greatest(size, F.lit(1)).cast("double"))).cast("int")


def kth_score_bounds(people_sets: DataFrame, job_sets: DataFrame, k: int, sample: int) -> DataFrame:
    """(pset, items, bound) per profile set: its skills, rare ones first, and a score that its kth best job set reaches at least.

    The bound is the kth best score among ``sample`` job sets of least hash, 0 where fewer than k of them share a skill: any
    part of the job sets gives a bound that holds for all. Skills no job asks for are the rarest.
    """
    frequency = job_sets.select(F.explode("required_skills").alias("skill")).groupBy("skill").agg(F.count("*").alias("n"))
    ranked = people_sets.select("pset", F.explode("have").alias("skill")).join(F.broadcast(frequency), "skill", "left")
    ranked = ranked.groupBy("pset").agg(F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "skill"))).alias("r"))
    few = job_sets.select("required_skills", "jset").orderBy(F.xxhash64("jset"), "jset").limit(sample)
    few = few.agg(F.collect_list("required_skills").alias("s")).scalar()  # at most `sample` sets
    mine = ranked.select("pset", F.transform("r", lambda x: x["skill"]).alias("items"))
    mine = mine.repartition(_tasks(job_sets), "pset").withColumn("_few", few)
    met = F.transform("_few", lambda s: F.struct(F.size(F.array_intersect("items", s)).alias("c"), F.size(s).alias("b")))
    scores = F.transform(met, lambda x: jaccard(x["c"].cast("double"), F.size("items"), x["b"]))
    kth = F.coalesce(F.get(F.sort_array(scores, asc=False), F.lit(k - 1)), F.lit(0.0))
    return mine.select("pset", "items", kth.alias("bound"))


def _signature(items: Column) -> Column:
    """One bit of 62 per skill. Each bit that only one of two sets has is a skill that only this one has."""
    bit = lambda x: F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(F.xxhash64(x), F.lit(BITS)).cast("int"))
    return F.aggregate(items, F.lit(0).cast("bigint"), lambda m, x: m.bitwiseOR(bit(x)))


def candidates(bounded: DataFrame, job_sets: DataFrame) -> DataFrame:
    """(pset, items, bound, skill, jset, required_skills) of the pairs that meet in the inverted index of the job sets.

    Job sets stand in a list for each skill and order of size. A set that reaches score t with one of a skills has between
    t * a and a / t skills and shares one of the a - ceil(t * a) + 1 rarest, so a profile set only asks for those
    skills and sizes. Lists longer than LIST are dealt out in parts, each of which is asked. A pair is let through if the
    signatures of the two sets leave the bound possible; that is decided inside the join, on numbers alone.
    """
    index = job_sets.withColumns({"sig_b": _signature(F.col("required_skills")), "b": F.size("required_skills")})
    index = index.select("jset", "required_skills", "sig_b", "b", _log_size(F.col("b")).alias("order"), F.explode("required_skills").alias("skill"))
    lists = index.groupBy("skill", "order").agg(F.ceil(F.count("*") / LIST).cast("int").alias("parts"))
    a, b, t = F.col("a"), F.col("b"), F.col("bound")
    bounded = bounded.withColumns({"sig_a": _signature(F.col("items")), "a": F.size("items")})
    prefix = F.slice("items", F.lit(1), F.greatest(a - F.ceil(t * a - 1e-9).cast("int") + 1, F.lit(1)))
    own = ["pset", "items", "bound", "sig_a", "a"]
    asked = bounded.select(*own, F.explode(F.when(t > 0, prefix).otherwise(F.col("items"))).alias("skill"))
    low, high = _log_size(F.ceil(t * a - 1e-9)), _log_size(F.floor(F.try_divide(a, t) + 1e-9))
    asked = asked.join(F.broadcast(lists), "skill").where((F.col("order") >= low) & ((t == 0) | (F.col("order") <= high)))
    asked = asked.select(*own, "skill", "order", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    dealt = index.join(F.broadcast(lists), ["skill", "order"]).withColumn("part", F.pmod(F.xxhash64("jset"), F.col("parts")).cast("int"))
    dealt = dealt.select("jset", "required_skills", "sig_b", "b", *(F.col(c).alias(f"_{c}") for c in ("skill", "order", "part")))
    asked = asked.repartition(_tasks(job_sets), "skill", "order", "part")
    same = _all(F.col(c) == F.col(f"_{c}") for c in ("skill", "order", "part"))
    sizes = (b >= t * a - 1e-9) & (b * t <= a + 1e-9)
    only = lambda x, y: F.bit_count(F.col(x).bitwiseAND(F.bitwise_not(F.col(y))))
    most = F.least(a - only("sig_a", "sig_b"), b - only("sig_b", "sig_a"))  # shared skills
    reach = most * (1 + t) >= t * (a + b) - 1e-9
    return asked.join(_spread(dealt), same & sizes & reach).select("pset", "items", "bound", "skill", "jset", "required_skills")


# Sets of more skills than this do not write out their subsets: they meet in the inverted index.
SMALL = 10


def _subsets(items: Column) -> Column:
    """Every part of a sorted set but the empty one, sorted themselves."""
    none = F.array(F.array().cast("array<string>"))
    grown = F.aggregate(items, none, lambda done, x: F.concat(done, F.transform(done, lambda s: F.concat(s, F.array(x)))))
    return F.slice(grown, F.lit(2), F.size(grown))


def shared_lists(job_sets: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """(shared, sizes) and (shared, b, jset): the job sets of ``b`` skills that hold all of ``shared``.

    ``sizes`` has the jobs of each b, in order of b; a list has the first k sets by number.
    """
    part = F.explode(_subsets(F.col("required_skills"))).alias("shared")
    parts = job_sets.repartition(_tasks(job_sets), "jset").select("jset", "n", F.size("required_skills").alias("b"), part)
    counts = parts.groupBy("shared", "b").agg(F.sum("n").alias("n")).groupBy("shared")
    sizes = counts.agg(F.sort_array(F.collect_list(F.struct("b", "n"))).alias("sizes"))
    return sizes, first_per_key(parts.select("shared", "b", "jset"), ["shared", "b"], ["jset"], k)


def _common(people_sets: DataFrame, job_sets: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """(pset, jset, score) among which are each profile set's k best of these job sets, and (pset, bound).

    A profile set A asks for the lists of all its parts S. A job set of b skills in the list of S scores |S| / (|A| + b - |S|)
    at least, and just that in the list of what it shares with A. Sets before it in that list score no less and have a smaller
    first job: where k of them leave it out, it is none of the k best. The jobs in the lists of one S differ, so they bound
    the kth best score from below, and lists that cannot reach the bound are not read.
    """
    sizes, lists = shared_lists(job_sets, k)
    a, c = F.col("a"), F.size("shared")
    asked = people_sets.repartition(_tasks(job_sets), "pset").select("pset", F.size("have").alias("a"), F.explode(_subsets(F.col("have"))).alias("shared"))
    upto = F.aggregate(
        "sizes",
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(None).cast("int").alias("b")),
        lambda s, x: F.struct((s["n"] + x["n"]).alias("n"), F.coalesce(s["b"], F.when(s["n"] + x["n"] >= k, x["b"])).alias("b")),
    )["b"]
    met = stored(asked.join(_spread(sizes), "shared").withColumn("reached", F.coalesce(jaccard(c, a, upto), F.lit(0.0))), "asked")
    bounds = stored(met.groupBy("pset").agg(F.max("reached").alias("bound")), "bounds")
    wanted = met.join(_spread(bounds), "pset").select("pset", "a", "bound", "shared", F.explode("sizes.b").alias("b"))
    wanted = wanted.withColumn("score", jaccard(c, a, F.col("b"))).where("score >= bound - 1e-9")
    found = wanted.join(_spread(lists), ["shared", "b"]).groupBy("pset", "jset").agg(F.max("score").alias("score"))
    return found, bounds


def _indexed(bounded: DataFrame, job_sets: DataFrame) -> DataFrame:
    """(pset, jset, score) of the pairs with a common skill that reach the bound.

    A pair that meets under several skills counts under the first of them.
    """
    met = candidates(bounded, job_sets)
    met = met.withColumn("shared", F.array_intersect("items", "required_skills"))
    found = F.when(F.get("shared", F.lit(0)) == F.col("skill"), F.size("shared"))
    met = met.select("pset", "jset", "bound", found.alias("c"), F.size("items").alias("a"), F.size("required_skills").alias("b"))
    scored = met.where("c > 0").select("pset", "jset", jaccard(F.col("c"), F.col("a"), F.col("b")).alias("score"), "bound")
    return scored.where("score >= bound - 1e-9").drop("bound")


def best_job_sets(people_sets: DataFrame, job_sets: DataFrame, k: int, sample: int = 1000) -> DataFrame:
    """(pset, jset, score) of pairs with a common skill among which are each profile set's k best.

    ``job_sets``: required_skills, jset (the first job), n (jobs).
    """
    few, many = F.size("have") <= SMALL, F.size("required_skills") <= SMALL
    narrow = people_sets.where(few)
    found, bounds = _common(narrow, job_sets.where(many), k)
    # Here the skills keep the order of the set: any order serves the index.
    reached = narrow.where(F.size("have") > 0).join(_spread(bounds), "pset", "left")
    reached = reached.select("pset", F.col("have").alias("items"), F.coalesce("bound", F.lit(0.0)).alias("bound"))
    wide = stored(kth_score_bounds(people_sets.where(~few), job_sets, k, sample), "wide")
    return found.unionByName(_indexed(reached, job_sets.where(~many))).unionByName(_indexed(wide, job_sets))


def skill_sets(profiles: DataFrame, everyone: DataFrame | None = None) -> DataFrame:
    """(profile_id, have): the sorted skill set of each profile; one of ``everyone`` without a mapped skill has the empty set."""
    sets = profiles.groupBy("profile_id").agg(F.array_sort(F.collect_set("skill_name")).alias("have"))
    if everyone is None:
        return sets
    empty = F.array().cast("array<string>")
    ids = everyone.select("profile_id").distinct()
    return ids.join(_spread(sets), "profile_id", "left").withColumn("have", F.coalesce(F.col("have"), empty))


@dataclass
class _Ranked:
    """What the answers are put together from: sets of profiles, and the k best jobs of every set."""

    people: DataFrame  # profile_id, have
    people_sets: DataFrame  # have, pset
    best: DataFrame  # pset, job_id, score
    stand_in: DataFrame  # job_id, required_skills


def _ranked(profiles: DataFrame, jobs: DataFrame, k: int, sample: int, everyone: DataFrame | None) -> _Ranked:
    people = stored(skill_sets(profiles, everyone), "people")
    people_sets = stored(people.groupBy("have").agg(F.min("profile_id").alias("pset")), "people-sets")
    # A set is named by its first job; at most k jobs stand for it. Jobs and sets feed many steps and are written once.
    jobs = stored(jobs.select("job_id", "required_skills"), "jobs")
    stand_in = first_per_key(jobs, ["required_skills"], ["job_id"], k)
    job_sets = stored(jobs.groupBy("required_skills").agg(F.min("job_id").alias("jset"), F.count("job_id").alias("n")), "job-sets")
    scored = best_job_sets(people_sets, job_sets, k, sample)
    best_sets = first_per_key(scored, ["pset"], [F.desc("score"), "jset"], k)
    members = stand_in.join(_spread(job_sets), "required_skills").select("jset", "job_id")
    positive = best_sets.join(_spread(members), "jset").select("pset", "job_id", "score")
    best = stored(first_per_key(positive, ["pset"], [F.desc("score"), "job_id"], k), "best")
    # Zeros fill the list where fewer than k jobs share a skill. The first 2k jobs are enough, as fewer
    # than k of them can be in the list already; such a double keeps its higher score.
    spare = jobs.select("job_id").orderBy("job_id").limit(2 * k)
    spare = spare.agg(F.array_sort(F.collect_list("job_id")).alias("s")).scalar()
    full = best.groupBy("pset").agg(F.count_distinct("job_id").alias("n")).where(F.col("n") >= k)
    short = people_sets.join(_spread(full), "pset", "left_anti")
    zeros = short.select("pset", F.explode(spare).alias("job_id"), F.lit(0.0).alias("score"))
    listed = best.unionByName(zeros).groupBy("pset", "job_id").agg(F.max("score").alias("score"))
    ranked = first_per_key(listed, ["pset"], [F.desc("score"), "job_id"], k)
    return _Ranked(people, people_sets, ranked, stand_in)


def top_matches(
    profiles: DataFrame, jobs: DataFrame, k: int, sample: int = 1000, everyone: DataFrame | None = None
) -> DataFrame:
    """The k best jobs of every profile: (profile_id, job_id, score, required_skills, missing_skills).

    ``profiles``: distinct (profile_id, skill_name). ``jobs``: job_id, required_skills.
    Ordered by score, then job id. Jobs that share nothing fill the list when better ones run out. ``sample`` job sets give
    profiles of many skills a first bound; it changes how much is searched, never the result.
    ``everyone`` names the profiles to answer, those without a mapped skill too: every job scores 0 for them.
    """
    r = _ranked(profiles, jobs, k, sample, everyone)
    named = r.people.join(_spread(r.people_sets), "have").select("profile_id", "have", "pset")
    out = named.join(_spread(r.best), "pset").join(_spread(r.stand_in.select("job_id", "required_skills")), "job_id", "left")
    return out.select(
        "profile_id",
        "job_id",
        F.col("score"),
        "required_skills",
        missing_skills(F.col("required_skills"), F.col("have")).alias("missing_skills"),
    )


def salary_suggestion(
    profiles: DataFrame, jobs: DataFrame, salary: str = "normalized_salary", n: int = 100, everyone: DataFrame | None = None
) -> DataFrame:
    """Per profile: quartiles of the salary over its n best matches that state one; zeros if there are none.

    Profiles of one skill set share their matches, so a set is worked out once. Its group has at most n rows, so the built-in
    percentile is enough. ``everyone`` as in ``top_matches``.
    """
    priced = stored(jobs.where(F.col(salary) > 0).select("job_id", "required_skills", salary), "priced")
    r = _ranked(profiles, priced, n, 1000, everyone)
    # A job id that stands twice counts as often as its lines among the matches.
    paid = r.best.join(_spread(r.stand_in.select("job_id")), "job_id").join(_spread(priced.select("job_id", salary)), "job_id")
    per_set = paid.groupBy("pset").agg(F.count("*").alias("pool"), F.percentile(salary, [0.25, 0.5, 0.75]).alias("q"))
    stats = r.people.join(_spread(r.people_sets.join(_spread(per_set), "pset")), "have").select("profile_id", "pool", "q")
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return (
        (profiles if everyone is None else everyone)
        .select("profile_id")
        .distinct()
        .join(_spread(stats), "profile_id", "left")
        .select(
            "profile_id",
            F.coalesce("pool", F.lit(0)).alias("pool"),
            zero(F.col("q")[0]).alias("suggested_min"),
            zero(F.col("q")[1]).alias("suggested_median"),
            zero(F.col("q")[2]).alias("suggested_max"),
        )
    )
