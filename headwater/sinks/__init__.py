"""Where results go: messages, pages and files."""
