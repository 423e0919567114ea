"""SQL counterparts of the registered queries, and the tool that compares both."""
