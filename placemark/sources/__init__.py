"""Table readers and page/sitemap sources."""
