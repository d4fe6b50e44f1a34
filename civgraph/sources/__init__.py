"""Raw sources: file contracts (S*), readers (R*) and preparation steps (P*)."""
