"""DataFrame -> DataFrame operators (chains, quotes, html tokens, encoding, ...)."""
