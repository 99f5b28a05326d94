"""Registered queries of the subpackage and their DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from rivalry.llm import conversation_trie, jaccard_tree, secret_scan, substring_dedup, topk_lists, warc
from rivalry.llm.ann import op4_ann
from rivalry.llm.decontaminate import op10_decontaminate
from rivalry.llm.html_text import op7_html_text
from rivalry.llm.language import op6_language
from rivalry.llm.sentencepiece_lattice import op1_sentencepiece
from rivalry.llm.store import located
from rivalry.llm.token_alignment import op12_token_alignment
from rivalry.llm.token_files import op2_token_files

QUERIES = {name: located(query) for name, query in {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_token_files": op2_token_files,
    "op3_warc": warc.op3_warc,
    "op4_ann": op4_ann,
    "op5_jaccard_join": jaccard_tree.op5_jaccard_join,
    "op6_language": op6_language,
    "op7_html_text": op7_html_text,
    "op8_substring_dedup": substring_dedup.op8_substring_dedup,
    "op9_secret_scan": secret_scan.op9_secret_scan,
    "op10_decontaminate": op10_decontaminate,
    "op11_topk": topk_lists.op11_topk,
    "op12_token_alignment": op12_token_alignment,
    "op13_conversation_trie": conversation_trie.op13_conversation_trie,
}.items()}

ORACLES = {
    "op3_warc": warc.ORACLE,
    "op5_jaccard_join": jaccard_tree.ORACLE,
    "op8_substring_dedup": substring_dedup.ORACLE,
    "op9_secret_scan": secret_scan.oracle(),
    "op11_topk": topk_lists.ORACLE,
    "op13_conversation_trie": conversation_trie.ORACLE,
}
