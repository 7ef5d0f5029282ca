"""Result files."""
