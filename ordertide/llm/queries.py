"""The operators of this folder as named queries over the given tables, and their SQL."""

from ordertide.llm.cover_tree import near_vectors_query
from ordertide.llm.crf_quality import crf_query
from ordertide.llm.decontaminate import DECONTAMINATE_SQL, decontaminate_query
from ordertide.llm.line_dedup import LINE_DEDUP_SQL, line_dedup_query
from ordertide.llm.ngram_join import NGRAM_JOIN_SQL, ngram_join_query
from ordertide.llm.periodic_runs import runs_query
from ordertide.llm.quality_rules import rules_query
from ordertide.llm.repeats import repeats_query
from ordertide.llm.sentencepiece_bpe import sentencepiece_query
from ordertide.llm.token_shards import shards_query
from ordertide.llm.toxicity import toxicity_query
from ordertide.llm.url_filter import URL_SQL, url_query
from ordertide.llm.whitening import whitening_query

QUERIES = {
    "op1_crf_quality": crf_query,
    "op2_toxicity": toxicity_query,
    "op3_decontaminate": decontaminate_query,
    "op4_url_filter": url_query,
    "op5_line_dedup": line_dedup_query,
    "op6_sentencepiece": sentencepiece_query,
    "op7_repeats": repeats_query,
    "op8_quality_rules": rules_query,
    "op9_token_shards": shards_query,
    "op10_ngram_join": ngram_join_query,
    "op11_embedding_near_dups": near_vectors_query,
    "op12_whitening": whitening_query,
    "op13_periodic_runs": runs_query,
}
ORACLE = {
    "op3_decontaminate": DECONTAMINATE_SQL,
    "op4_url_filter": URL_SQL,
    "op5_line_dedup": LINE_DEDUP_SQL,
    "op10_ngram_join": NGRAM_JOIN_SQL,
}
