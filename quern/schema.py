"""Declared schemas of the nested records; nothing is inferred from data."""

#: A parsed document as parsers write it (V2) and the canonical form (V1).
PARSED_V2 = (
    "doc_name string, source_path string, num_pages int, backend string, ocr_model string, "
    "content array<struct<page_id:int, page_number:int, text:string, ocr_used:boolean, sheet_title:string, section:string>>, error string, interrupted boolean"
)
PARSED_V1 = (
    "metainfo struct<sha1_name:string, pages_amount:int, source_path:string, backend:string, ocr_model:string>, "
    "content array<struct<page:int, content:array<struct<type:string, text:string>>, page_dimensions:map<string,string>>>"
)
#: Either form, for reading a folder that holds both.
PARSED_ANY = (
    "doc_name string, source_path string, num_pages int, backend string, ocr_model string, error string, interrupted boolean, metainfo struct<sha1_name:string, pages_amount:int, source_path:string, backend:string, ocr_model:string>, "
    "content array<struct<page_id:int, page_number:int, text:string, ocr_used:boolean, sheet_title:string, section:string, page:int, content:array<struct<type:string, text:string>>, page_dimensions:map<string,string>>>"
)
QUESTION = "qid bigint, question string, answer_type string"
#: An answer is an integer, a float, a string, a boolean or null: a VARIANT at the edges.
ANSWER = "question_id bigint, relevant_chunks array<struct<document_name:string, page_number:int>>, answer variant"
#: The working form of an answer; ``marker`` groups equal answers, as VARIANT can't be grouped.
VALUE = "struct<kind:string, s:string, i:bigint, d:double, b:boolean, marker:string>"
