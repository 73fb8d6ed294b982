"""Schemas of the entities that pass between stages."""

from __future__ import annotations

PAGE_REFS = "array<struct<page_idx:int,block_id:string,block_position:string>>"
BLOCK = f"doc_id string, pos int, text string, block_type string, page_refs {PAGE_REFS}, heading_level int, source_hint string"
SEGMENT = f"doc_id string, seg_no int, text string, page_refs {PAGE_REFS}, section string, article string, subarticle string, heading_path array<string>"
METADATA = "struct<year:string,name:string,brief_description:string,section:string,article:string,subarticle:string,heading_path:array<string>,language_hint:string>"
CHUNK = (
    "chunk_id string, doc_id string, chunk_index int, text string, augmented_text string, token_count int, char_count int,"
    f" source_path string, source_file string, page_start int, page_end int, page_refs {PAGE_REFS}, metadata {METADATA}"
)
DOCUMENT = (
    "doc_id string, source_folder string, source_md_path string, source_mode_used string, name string, year string,"
    " brief_description string, language_hint string, stats struct<blocks:int,chunks:int,pages:int,tokens:int>"
)
CACHE_ENTRY = "doc_id string, source_folder string, content_hash string, processing_signature string"
#: Layout of ``block_list.json``; fields of a wrong type become null.
BLOCK_LIST = (
    "pdfData array<array<struct<type:string,text:string,content:string,table_body:string,page_idx:int,level:int,"
    "block_position:string,id:string,is_discarded:boolean>>>,"
    " mergeConnections array<struct<id:string,type:string,blocks:array<string>>>"
)
#: Layout of ``*_content_list.json``.
CONTENT_LIST = (
    "array<struct<type:string,text:string,text_level:int,page_idx:int,table_body:string,"
    "table_caption:array<string>,table_footnote:array<string>>>"
)
