"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from keelson.llm import chat, collocations, exact_dedup, filter_audit, html_extract, line_dedup, mixing, quality, sentence_pieces, simhash, token_counts, token_files, warc


def queries() -> dict:
    return {
        "op1_sentencepiece": sentence_pieces.op1_sentencepiece,
        "op2_html_extract": html_extract.op2_html_extract,
        "op3_quality": quality.op3_quality,
        "op4_line_dedup": line_dedup.op4_line_dedup,
        "op5_mixing": mixing.op5_mixing,
        "op6_token_files": token_files.op6_token_files,
        "op7_token_counts": token_counts.op7_token_counts,
        "op8_warc": warc.op8_warc,
        "op9_exact_dedup": exact_dedup.op9_exact_dedup,
        "op10_simhash": simhash.op10_simhash,
        "op11_collocations": collocations.op11_collocations,
        "op12_chat": chat.op12_chat,
        "op13_filter_audit": filter_audit.op13_filter_audit,
        "quality_base_counts": quality.quality_base_counts,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "quality_base_counts": quality.BASE_SQL,
        "op5_mixing": mixing.SQL,
        "op8_warc": warc.SQL,
        "op9_exact_dedup": exact_dedup.SQL,
        "op11_collocations": collocations.SQL,
        "op12_chat": chat.SQL,
        "op13_filter_audit": filter_audit.SQL,
    }
