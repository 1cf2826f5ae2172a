"""Reading records: listing files, landed pages, JSON-LD, source registry; and writing results."""
