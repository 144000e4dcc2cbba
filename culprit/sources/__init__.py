"""Reading and writing tables, the mixture configuration and models."""
