"""What the plans must look like, whatever the size of the data."""

import pytest
from pyspark.sql.classic.dataframe import DataFrame

from tagpulse import session
from tagpulse.plans.queries import QUERIES


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def plans_of(spark, monkeypatch):
    """All plans that a query runs, those behind its checkpoints too."""

    def run(name, sf_dir):
        seen, checkpoint = [], DataFrame.checkpoint

        def recorded(df, *args):
            seen.append(plan(df))
            return checkpoint(df, *args)

        monkeypatch.setattr(DataFrame, "checkpoint", recorded)
        last = plan(QUERIES[name](spark, sf_dir))
        return [*seen, last]

    return run


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith("stream_") and n != "raw_log_copy"))
def test_stays_in_the_jvm_without_cross_joins(plans_of, name):
    for text in plans_of(name, "/root/testdata/sf0.001"):
        for node in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"):
            assert node not in text


@pytest.mark.parametrize("name, key", [("compare_users", "tag"), ("compare_country_tags", "country"), ("compare_users_longer_record", "tag")])
def test_parts_are_not_joined_on_the_bare_key(spark, plans_of, name, key):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        last = plans_of(name, "/root/testdata/sf0.001")[-1]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    joins = [line for line in last.splitlines() if "SortMergeJoin" in line]
    assert joins and all("part#" in line for line in joins)
    assert not any("LeftSemi" in line for line in joins)


def test_scan_reads_only_what_is_needed(spark, sf_dir):
    text = plan(QUERIES["avg_words_per_tag"](spark, sf_dir))
    assert "IsNotNull(text)" in text
    assert "ReadSchema: struct<doc_id:bigint,text:string,lang:string,source:string>" in text
    text = plan(QUERIES["window_user_counts"](spark, sf_dir))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in text


@pytest.mark.parametrize("name", ["longest_word_per_tag", "token_stats_per_tag", "window_longest_word"])
def test_text_is_split_once(spark, sf_dir, name):
    assert plan(QUERIES[name](spark, sf_dir)).count("regexp_extract_all") == 1


def test_windows_follow_the_ranges_without_another_shuffle(spark, sf_dir):
    text = plan(QUERIES["running_tag_count"](spark, sf_dir))
    rows_side = text[:text.index("Union")]
    assert rows_side.count("Exchange") == 1 and "REPARTITION_BY_NUM" in rows_side


class Cluster:
    """A session as far as `shared_folder` looks at it."""

    def __init__(self, master, folder=None):
        self.sparkContext = self
        self.master, self.folder, self.used = master, folder, None
        self.conf = self

    def get(self, key, default):
        return self.folder or default

    def getCheckpointDir(self):
        return self.used

    def setCheckpointDir(self, folder):
        self.used = folder


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError):
        session.shared_folder(Cluster("yarn"))
    cluster = Cluster("yarn", "hdfs:///shared")
    assert session.shared_folder(cluster) == "hdfs:///shared" == cluster.used
    local = Cluster("local[2]")
    assert session.shared_folder(local) == session.shared_folder(local) == local.used
