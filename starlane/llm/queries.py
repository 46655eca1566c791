"""The operators as queries over the sample tables, with SQL where it can express them."""

from __future__ import annotations

from starlane.llm.byte_pairs import op4_byte_pairs
from starlane.llm.languages import op5_languages
from starlane.llm.leaks import OP13_SQL, op13_leaks
from starlane.llm.licences import OP8_SQL, op8_licences
from starlane.llm.middles import OP12_SQL, op12_middles
from starlane.llm.near_dups import op9_near_dups
from starlane.llm.neighbours import op10_neighbours
from starlane.llm.outliers import op3_outliers
from starlane.llm.packing import op7_packing
from starlane.llm.prefixes import op11_prefixes
from starlane.llm.token_files import op1_token_files
from starlane.llm.warc import OP6_SQL, op6_warc
from starlane.llm.wrappers import op2_main_text

QUERIES = {
    "op1_token_files": op1_token_files,
    "op2_main_text": op2_main_text,
    "op3_outliers": op3_outliers,
    "op4_byte_pairs": op4_byte_pairs,
    "op5_languages": op5_languages,
    "op6_warc": op6_warc,
    "op7_packing": op7_packing,
    "op8_licences": op8_licences,
    "op9_near_dups": op9_near_dups,
    "op10_neighbours": op10_neighbours,
    "op11_prefixes": op11_prefixes,
    "op12_middles": op12_middles,
    "op13_leaks": op13_leaks,
}

ORACLE: dict[str, str] = {
    "op6_warc": OP6_SQL,
    "op8_licences": OP8_SQL,
    "op12_middles": OP12_SQL,
    "op13_leaks": OP13_SQL,
}
