import re

from tests.conftest import SF
from tidemark.sources import tables as S


def test_feed_entries_shuffle_texts_once(spark, capsys):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        S.rss(spark, SF).explain("formatted")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    exchanges = [x for x in capsys.readouterr().out.split("\n\n") if re.match(r"\s*\(\d+\) Exchange", x)]
    assert len(exchanges) > 2 and sum("text#" in x for x in exchanges) == 1
