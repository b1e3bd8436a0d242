"""Queries of the operators (one opN_<name> each) and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from . import chat, embeddings, fingerprint, html_text, jaccard, mixing, packing, pieces, quality, search, substring, tokenfile, trie

_MODULES = (substring, html_text, embeddings, chat, fingerprint, mixing, jaccard, packing, tokenfile, quality, pieces, trie, search)

QUERIES = {name: fn for m in _MODULES for name, fn in vars(m).items() if name.startswith("op") and name[2:3].isdigit()}
ORACLES = {
    "op4_chat_formatting": chat.oracle_sql(),
    "op7_ngram_jaccard_join": jaccard.oracle_sql(),
    "op12_conversation_trie": trie.oracle_sql(),
    "op13_ranked_search": search.oracle_sql(),
}
