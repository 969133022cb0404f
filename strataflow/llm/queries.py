"""The registered queries of this subpackage and, where SQL can say it, what they must equal."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataflow.llm.collocations import mine_phrases
from strataflow.llm.decontaminate import find_leaks
from strataflow.llm.exact_dedup import dedup_exact
from strataflow.llm.filter_audit import audit_filters
from strataflow.llm.mixing import mix_sources
from strataflow.llm.oracles import AUDIT_SQL, DEDUP_SQL, MIX_SQL, PHRASES_SQL, SECRETS_SQL, SHARD_SQL, URL_SQL
from strataflow.llm.quality import score_quality
from strataflow.llm.rules import judge_quality
from strataflow.llm.secrets import secret_digest
from strataflow.llm.sharding import shard_digest
from strataflow.llm.simhash import duplicate_digest
from strataflow.llm.tokens import count_tokens
from strataflow.llm.toxicity import score_toxicity
from strataflow.llm.url_filter import LISTED_SITES, canonical, host_of, judge_urls
from strataflow.registry.inputs import table

QUERIES = {}
ORACLES = {}


def query(name, sql=None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


@query("op1_sharding", SHARD_SQL)
def op1_sharding(spark, sf):
    return shard_digest(table(spark, sf, "documents"))


@query("op2_mixing", MIX_SQL)
def op2_mixing(spark, sf):
    """Rows of the mixture: each document once an epoch of its source."""
    return mix_sources(table(spark, sf, "documents").select("doc_id", "source"))


@query("op4_url_filter", URL_SQL)
def op4_url_filter(spark, sf):
    """Listed are half of the canonical URLs of some sites, by hash, and as many that no page has."""
    pages = table(spark, sf, "pages").select("page_id", "url")
    sites = "|".join(LISTED_SITES)
    known = pages.where(host_of(F.col("url")).rlike(rf"(^|\.)({sites})\.")).select(canonical(F.col("url")).alias("canonical"))
    half = F.substring(F.md5("canonical"), 1, 1) < "8"
    gone = known.select(F.concat("canonical", F.lit("/gone")).alias("canonical"))
    return judge_urls(pages, known.where(half).unionByName(gone))


@query("op5_secrets", SECRETS_SQL)
def op5_secrets(spark, sf):
    return secret_digest(table(spark, sf, "documents"))


@query("op3_quality_classifier")
def op3_quality_classifier(spark, sf):
    return score_quality(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query("op6_decontamination")
def op6_decontamination(spark, sf):
    return find_leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query("op7_token_counts")
def op7_token_counts(spark, sf):
    return count_tokens(table(spark, sf, "documents"))


@query("op8_toxicity")
def op8_toxicity(spark, sf):
    return score_toxicity(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query("op9_simhash_near_dedup")
def op9_simhash_near_dedup(spark, sf):
    return duplicate_digest(table(spark, sf, "documents"))


@query("op10_quality_rules")
def op10_quality_rules(spark, sf):
    return judge_quality(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query("op11_collocations", PHRASES_SQL)
def op11_collocations(spark, sf):
    return mine_phrases(table(spark, sf, "documents"))


@query("op12_filter_audit", AUDIT_SQL)
def op12_filter_audit(spark, sf):
    return audit_filters(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query("op13_exact_dedup", DEDUP_SQL)
def op13_exact_dedup(spark, sf):
    """Of equal texts the row with the largest doc_id stays."""
    return dedup_exact(table(spark, sf, "documents"), keep="largest")
