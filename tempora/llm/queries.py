"""Registered queries of the training-data operators and their SQL twins."""

from __future__ import annotations

from tempora.llm.chat import OP7_SQL, op7_chat
from tempora.llm.infill import OP12_SQL, op12_infill
from tempora.llm.langid import op6_langid
from tempora.llm.mixing import op1_mixing
from tempora.llm.nbsvm import op11_nbsvm
from tempora.llm.packed import op4_packed
from tempora.llm.pages import op10_pages
from tempora.llm.passages import op9_passages
from tempora.llm.pieces import op8_pieces
from tempora.llm.quality import OP3_SQL, op3_quality
from tempora.llm.repair import OP13_SQL, op13_repair
from tempora.llm.simhash import op5_simhash
from tempora.llm.vafile import OP2_SQL, op2_topk

QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_topk": op2_topk,
    "op3_quality": op3_quality,
    "op4_packed": op4_packed,
    "op5_simhash": op5_simhash,
    "op6_langid": op6_langid,
    "op7_chat": op7_chat,
    "op8_pieces": op8_pieces,
    "op9_passages": op9_passages,
    "op10_pages": op10_pages,
    "op11_nbsvm": op11_nbsvm,
    "op12_infill": op12_infill,
    "op13_repair": op13_repair,
}

ORACLE: dict[str, str] = {"op2_topk": OP2_SQL, "op3_quality": OP3_SQL, "op7_chat": OP7_SQL, "op12_infill": OP12_SQL, "op13_repair": OP13_SQL}
