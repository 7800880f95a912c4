"""Explicit schemas; nothing is inferred from data."""

RAW_DOCUMENT = "id string, title string, author string, text string, tags array<string>, source_url string, source_archive string, created_date string, raw_metadata map<string,string>"
CORPUS_CSV = ["id", "path", "orientation", "category", "story_slug", "chapter_num", "title", "author_name", "author_email", "publication_date", "url", "char_count", "word_count", "content", "created_at", "date_source"]
CHUNK = "id bigint, chunk_index smallint, start_offset int, end_offset int, chunk_text string, embedding array<float>"
CHUNK_LINE = "id bigint, content string"
MENTION = "story_id bigint, etype string, label string"
