import random

from pyspark.sql import functions as F

from vacancia.operators import matching


def _brute(people, jobs, k):
    out = {}
    for pid, have in people.items():
        scored = []
        for jid, need in jobs.items():
            union = have | need
            scored.append((-(len(have & need) / len(union) if union else 0.0), jid))
        out[pid] = [(j, round(-s, 9)) for s, j in sorted(scored)[:k]]
    return out


def _frames(spark, people, jobs):
    p = spark.createDataFrame([(i, x) for i, v in people.items() for x in v], "profile_id bigint, skill_name string")
    rows = [(i, sorted(v)) for i, v in jobs.items()]
    return p, spark.createDataFrame(rows, "job_id bigint, required_skills array<string>")


def test_top_matches_equal_brute_force(spark):
    rng = random.Random(5)
    names = [f"s{i}" for i in range(9)]
    jobs = {i: set(rng.sample(names, rng.randint(0, 4))) for i in range(400)}
    jobs |= {i: {"s0"} for i in range(400, 600)}  # a hot set: a third of all jobs
    people = {i: set(rng.sample(names + ["rare"], rng.randint(1, 4))) for i in range(60)}
    people[60] = {"unheard"}  # shares nothing with any job
    for k in (1, 5, 40):
        got = {}
        for r in matching.top_matches(*_frames(spark, people, jobs), k).collect():
            got.setdefault(r["profile_id"], []).append((r["job_id"], round(r["score"], 9)))
            assert set(r["missing_skills"]) == jobs[r["job_id"]] - people[r["profile_id"]]
            assert set(r["required_skills"]) == jobs[r["job_id"]]
        unbounded = matching.top_matches(*_frames(spark, people, jobs), k, sample=1).select("profile_id", "job_id", "score")
        bounded = matching.top_matches(*_frames(spark, people, jobs), k).select("profile_id", "job_id", "score")
        assert sorted(unbounded.collect()) == sorted(bounded.collect())
        want = _brute(people, jobs, k)
        assert {p: sorted(v, key=lambda x: (-x[1], x[0])) for p, v in got.items()} == want


def test_many_skills(spark):
    rng = random.Random(6)
    names = [f"s{i:03}" for i in range(150)]
    jobs = {i: set(rng.sample(names, rng.randint(1, 20))) for i in range(120)}
    people = {i: set(rng.sample(names, 12)) for i in range(20)}
    got = {}
    for r in matching.top_matches(*_frames(spark, people, jobs), 4).collect():
        got.setdefault(r["profile_id"], []).append((r["job_id"], round(r["score"], 9)))
    assert {p: sorted(v, key=lambda x: (-x[1], x[0])) for p, v in got.items()} == _brute(people, jobs, 4)


def test_bounds_prune_and_frequent_skills_are_dealt_out(spark, monkeypatch):
    """A skill that every job asks for, and one of its own: the index finds the own one, and long lists split."""
    monkeypatch.setattr(matching, "LIST", 50)
    rng = random.Random(7)
    names = [f"s{i}" for i in range(200)]
    jobs = {i: {"common", *rng.sample(names, rng.randint(0, 7))} for i in range(1500)}
    people = {i: {"common", *rng.sample(names, 5)} for i in range(40)}
    people |= {100 + i: set(jobs[i * 7]) for i in range(20)}
    p, j = _frames(spark, people, jobs)
    got = {}
    for r in matching.top_matches(p, j, 3).collect():
        got.setdefault(r["profile_id"], []).append((r["job_id"], round(r["score"], 9)))
    assert {i: sorted(v, key=lambda x: (-x[1], x[0])) for i, v in got.items()} == _brute(people, jobs, 3)
    job_sets = j.groupBy("required_skills").agg(F.min("job_id").alias("jset"))
    mine = matching.skill_sets(p).groupBy("have").agg(F.min("profile_id").alias("pset"))
    met = matching.candidates(matching.kth_score_bounds(mine, job_sets, 3, 500), job_sets)
    assert 0 < met.count() < 0.5 * mine.count() * job_sets.count()


def test_narrow_and_wide_sets_meet_without_a_pair_list(spark, monkeypatch):
    """Sets beyond SMALL go by the index, the others by shared parts; of a long list only its first k sets are read."""
    rng = random.Random(8)
    names = [f"s{i:02}" for i in range(12)]
    jobs = {i: set(rng.sample(names, rng.randint(0, 7))) for i in range(700)}
    people = {i: set(rng.sample(names, rng.randint(0, 7))) for i in range(50)}
    p, j = _frames(spark, people, jobs)
    everyone = spark.createDataFrame([(i,) for i in people], "profile_id bigint")
    for small in (3, 10):
        monkeypatch.setattr(matching, "SMALL", small)
        for k in (2, 30):
            got = {}
            for r in matching.top_matches(p, j, k, everyone=everyone).collect():
                got.setdefault(r["profile_id"], []).append((r["job_id"], round(r["score"], 9)))
            assert {i: sorted(v, key=lambda x: (-x[1], x[0])) for i, v in got.items()} == _brute(people, jobs, k)
    job_sets = j.groupBy("required_skills").agg(F.min("job_id").alias("jset"), F.count("job_id").alias("n"))
    mine = matching.skill_sets(p).groupBy("have").agg(F.min("profile_id").alias("pset"))
    meet = mine.crossJoin(job_sets).where(F.arrays_overlap("have", "required_skills")).count()
    assert matching.best_job_sets(mine, job_sets, 2).count() < 0.1 * meet


def test_few_jobs_fill_with_zero_scores(spark):
    jobs = {3: {"a"}, 1: {"b"}, 2: set(), 9: {"a", "b"}}
    people = {7: {"a"}, 8: {"z"}}
    got = sorted((r["profile_id"], -r["score"], r["job_id"]) for r in matching.top_matches(*_frames(spark, people, jobs), 3).collect())
    assert got == [(7, -1.0, 3), (7, -0.5, 9), (7, 0, 1), (8, 0, 1), (8, 0, 2), (8, 0, 3)]


def test_profiles_without_a_mapped_skill_are_answered(spark):
    p, jobs = _frames(spark, {7: {"a"}}, {3: {"a"}, 1: {"b"}, 2: set()})
    everyone = spark.createDataFrame([(7,), (8,), (8,)], "profile_id bigint")
    best = matching.top_matches(p, jobs, 2, everyone=everyone)
    got = sorted((r["profile_id"], -r["score"], r["job_id"], r["missing_skills"]) for r in best.collect())
    assert got == [(7, -1.0, 3, []), (7, 0, 1, ["b"]), (8, 0, 1, ["b"]), (8, 0, 2, [])]
    paid = jobs.withColumn("normalized_salary", F.col("job_id") * 100.0)
    pools = {r["profile_id"]: (r["pool"], r["suggested_median"]) for r in matching.salary_suggestion(p, paid, everyone=everyone).collect()}
    assert pools == {7: (3, 200.0), 8: (3, 200.0)}


def test_map_skills_by_alias_and_name(spark):
    words = [(1, "Python 3"), (1, "Project Management"), (2, "Writing"), (3, "DATABASES"), (4, "cooking")]
    p = spark.createDataFrame(words, "profile_id bigint, skill string")
    skills = spark.createDataFrame(
        [("IT", "Information Technology"), ("PRJM", "project management")], "skill_abr string, skill_name string"
    )
    sub = {tuple(r) for r in matching.map_skills(p, skills).collect()}
    it = "Information Technology"
    assert sub == {(1, it), (1, "project management"), (2, it), (3, it)}  # "it" occurs in "Writing"
    tok = {tuple(r) for r in matching.map_skills(p, skills, match="token").collect()}
    assert tok == {(1, it), (1, "project management")}


def test_score_jobs_keeps_jobs_without_skills(spark):
    p, jobs = _frames(spark, {1: {"a", "b"}}, {1: set(), 2: {"a"}, 3: {"a", "b", "c"}})
    got = {r["job_id"]: (r["matching_score"], r["missing_skills"]) for r in matching.score_jobs(p, jobs).collect()}
    assert got == {1: (0.0, []), 2: (0.5, []), 3: (0.6667, ["c"])}


def test_salary_suggestion_zero_without_priced_jobs(spark):
    p, jobs = _frames(spark, {1: {"a"}}, {1: {"a"}, 2: {"b"}})
    none = jobs.withColumn("normalized_salary", F.lit(None).cast("double"))
    assert tuple(matching.salary_suggestion(p, none).first()) == (1, 0, 0.0, 0.0, 0.0)
    some = jobs.withColumn("normalized_salary", F.col("job_id") * 100.0)
    assert tuple(matching.salary_suggestion(p, some).first()) == (1, 2, 125.0, 150.0, 175.0)


def test_nothing_that_grows_goes_by_way_of_the_driver(spark, monkeypatch):
    """Lists of skill sets look small to Spark, packed as they are; a broadcast of them took half a gigabyte of the driver."""
    rng = random.Random(8)
    names = [f"s{i}" for i in range(14)]
    jobs = {i: set(rng.sample(names, rng.randint(0, 12))) for i in range(120)}
    people = {i: set(rng.sample(names, rng.randint(1, 12))) for i in range(30)}
    p, j = _frames(spark, people, jobs)
    priced = j.withColumn("normalized_salary", F.lit(5.0))
    plans = []
    stored = matching.stored
    monkeypatch.setattr(matching, "stored", lambda df, name: plans.append(df) or stored(df, name))
    plans += [matching.top_matches(p, j, 5), matching.salary_suggestion(p, priced, n=5)]
    for df in plans:
        for line in str(df._jdf.queryExecution().executedPlan()).split("\n"):
            if "BroadcastHashJoin" in line or "BroadcastNestedLoopJoin" in line:
                assert "[skill#" in line, line  # figures per skill alone
