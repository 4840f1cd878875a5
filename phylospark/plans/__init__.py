"""plans of the library."""
