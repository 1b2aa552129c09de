"""Tables written in the shared folder: those of ``innkeep.sources.shared``."""

from innkeep.sources.shared import Scratch, cut, materialize, new_path, remove, scratch, shared_dir

__all__ = ["Scratch", "cut", "materialize", "new_path", "remove", "scratch", "shared_dir"]
