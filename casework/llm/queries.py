"""Queries of this subpackage over the standard tables, and their SQL twins."""

from casework.llm import chat, collocations, language, licenses, mixing, near, neighbours, packing, pages, quality, resampling, scoring, secrets

_QUERIES = [
    mixing.op1_mixing, licenses.op2_licenses, chat.op3_chat, pages.op4_pages, scoring.op5_scoring, quality.op6_quality, neighbours.op7_neighbours, secrets.op8_secrets, packing.op9_packing, near.op10_near,
    collocations.op11_collocations, language.op12_language, resampling.op13_resampling,
]
_SQL = {
    "op1_mixing": mixing.OP1_SQL, "op2_licenses": licenses.OP2_SQL, "op3_chat": chat.OP3_SQL, "op6_quality": quality.OP6_SQL,
    "op8_secrets": secrets.OP8_SQL, "op11_collocations": collocations.OP11_SQL, "op13_resampling": resampling.OP13_SQL,
}


def queries():
    return {fn.__name__: fn for fn in _QUERIES}


def oracle_sql():
    return dict(_SQL)
