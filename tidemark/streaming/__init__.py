"""Running jobs: settings, handles, savepoints and state."""
