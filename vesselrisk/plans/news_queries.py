"""News-context query (X1) over the landed documents, with oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..oracle import with_views
from ..sources.fixtures import Fixtures
from ..sources.tables import read_table
from . import news
from .registry import finish, register

NEWS_SQL = with_views("vessel_meta", extra=[
    ("dt", r"""SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\pL\pN]+'), lambda t: t <> '') AS t FROM documents"""),
    ("dl", "SELECT doc_id, len(t) AS dl FROM dt"),
    ("tf", "SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(t) AS term FROM dt) GROUP BY ALL"),
    ("st", "SELECT count(*) AS n, avg(dl) AS avgdl FROM dl"),
    ("dfq", "SELECT term, count(*) AS df FROM tf GROUP BY term"),
    ("s", """SELECT tf.term, tf.doc_id, ln(1 + (st.n - dfq.df + 0.5) / (dfq.df + 0.5)) * tf.tf * 2.2
               / (tf.tf + 1.2 * (1 - 0.75 + 0.75 * dl.dl / st.avgdl)) AS s
             FROM tf JOIN dl USING (doc_id) JOIN dfq USING (term) CROSS JOIN st"""),
    ("qw", r"""SELECT mmsi, COALESCE(flag, '') AS flag,
        list_filter(regexp_split_to_array(upper(COALESCE(name, '')), '\s+'), lambda w: length(w) >= 3) AS w FROM vessel_meta"""),
    ("qt", r"""SELECT DISTINCT mmsi, unnest(list_filter(regexp_split_to_array(lower(flag || ' ' || array_to_string(w[1:2], ' ')),
        '[^\pL\pN]+'), lambda t: t <> '')) AS term FROM qw"""),
    ("sc", "SELECT qt.mmsi, s.doc_id, sum(s.s) AS score FROM qt JOIN s USING (term) GROUP BY ALL"),
    ("best", "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY mmsi ORDER BY score DESC, doc_id DESC) AS r FROM sc) WHERE r <= 9"),
]) + """SELECT mmsi, CAST(rank AS BIGINT) AS rank, doc_id, round(score, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY mmsi ORDER BY doc_id DESC) AS rank FROM best) WHERE rank <= 3"""


@register("news_context", NEWS_SQL)
def q_news_context(spark, base):
    fx = Fixtures(spark, base)
    docs = read_table(spark, base, "documents").select("doc_id", "text")
    return finish(news.news_context(fx.vessel_meta.select("mmsi", "name", "flag"), docs))
