"""Physical-plan policies: size-checked broadcast, materialisation points, plan inspection."""
