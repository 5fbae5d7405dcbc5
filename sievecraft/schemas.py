"""Schemas of all tables, as DDL; nothing is inferred."""

REPOSITORY = "full_name string, owner struct<login:string>, name string, default_branch string, stargazers_count long, size long, fork boolean, archived boolean, license struct<spdx_id:string>"
TREE_ENTRY = "path string, type string, sha string, size long"
ARCHIVE_FILE = "archive string, ord int, file_path string, size long, raw binary"
FINDING = "type string, line_number long"
MANIFEST = "repository string, file_path string, branch string, tree_sha string, file_sha string, license string, stars long, source_url string, exact_hash string, structural_hash string, characters long, non_empty_lines long, tokens long, split string"
SEARCH_HIT = "query_name string, page long, position long, repo string"
#: What a search gives: its hits, and after each page a row without position that says where to go on.
SEARCH_ROW = f"{SEARCH_HIT}, next_page long, exhausted boolean"

STATE = {
    "repositories": "full_name string, status string, stars long, license string, candidate_json string, selected_at timestamp, crawled_at timestamp, updated_at timestamp, last_error string",
    "query_hits": "full_name string, query_name string, first_seen_at timestamp",
    "query_progress": "query_name string, query_text string, next_page long, exhausted boolean, updated_at timestamp",
    "code_hashes": "hash_type string, hash_value string, repository string, file_path string, split string, created_at timestamp",
}
