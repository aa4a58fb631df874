"""Operations for large text corpora: filtering, near-duplicate search, personal-data spans,
mixing, tokenizing, language labels and vector search. Nothing else in the library imports
this subpackage; it imports only general helpers (session, registry)."""
